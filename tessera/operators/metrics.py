"""Metrics over prediction tables, each in one or two aggregate passes. `by`
gives the metric per fold, branch or target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.operators.windows import running


def _group(df: DataFrame, by):
    return df.groupBy(*by) if by else df.groupBy()


def f1_counts(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + fp + fn), F.lit(0.0))


def f1_at(df: DataFrame, t: float, y: str = "y", p: str = "p", by=()) -> DataFrame:
    hit, pos = F.col(p) >= t, F.col(y) == 1
    return _group(df, by).agg(f1_counts(F.count_if(hit & pos), F.count_if(hit & ~pos), F.count_if(~hit & pos)).alias("f1"))


def best_threshold(df: DataFrame, y: str = "y", p: str = "p", by=()) -> DataFrame:
    """Largest F1 over .30, .31 .. .69, the lowest threshold on ties; .5 if all
    are 0. Rows fall into forty bins once; the grid works on the bins."""
    grid = [k / 100 for k in range(30, 70)]
    # number of thresholds at most p: by its hundredths, set right beside the thresholds themselves
    x, at = F.col(p).cast("double"), lambda k: F.get(F.array(*map(F.lit, grid)), k)
    near = F.floor(F.greatest(F.least(x, F.lit(1.0)), F.lit(0.0)) * 100).cast("int") - 29
    near = F.greatest(F.least(near, F.lit(len(grid))), F.lit(0))
    df = df.withColumn("_near", F.when(x.isNotNull(), near))
    near = F.col("_near")
    bin_ = near + F.coalesce(x >= at(near), F.lit(False)).cast("int") - F.coalesce(x < at(near - 1), F.lit(False)).cast("int")
    n = _group(df, [*by, bin_.alias("_b")]).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    all_ = n.groupBy(*by).agg(F.sum("pos").alias("_p")) if by else n.agg(F.sum("pos").alias("_p"))
    steps = n.filter("_b > 0").select(*by, "pos", "neg", F.explode(F.sequence(F.lit(1), F.col("_b"))).alias("_k"))
    at = steps.groupBy(*by, "_k").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("fp"))
    at = at.join(all_, list(by)) if by else at.crossJoin(F.broadcast(all_))
    at = at.select(*by, F.element_at(F.array(*map(F.lit, grid)), F.col("_k")).alias("threshold"), f1_counts(F.col("tp"), F.col("fp"), F.col("_p") - F.col("tp")).alias("f1"))
    best = _group(at, by).agg(F.max_by(F.struct("threshold", "f1"), F.struct("f1", -F.col("threshold"))).alias("b"))
    out = all_.join(best, list(by), "left") if by else all_.crossJoin(best)
    ok = F.coalesce(F.col("b.f1"), F.lit(0.0)) > 0
    return out.select(*by, F.when(ok, F.col("b.threshold")).otherwise(0.5).alias("threshold"), F.when(ok, F.col("b.f1")).otherwise(0.0).alias("f1"))


def roc_auc(df: DataFrame, y: str = "y", p: str = "p", by=()) -> DataFrame:
    """Exact rank-sum AUC, ties halved, over counts per distinct score; null with
    one class only."""
    n = df.groupBy(*by, p).agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    under = running(n, p, {"upto": "neg"}, by).withColumn("below", F.col("upto") - F.col("neg"))
    area = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2))
    return _group(under, by).agg(F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def macro_ovr_auc(df: DataFrame, y: str, prob: str, classes: int, by=()) -> DataFrame:
    long = df.select(*by, F.col(y).alias("_y"), F.posexplode(prob).alias("_c", "p")).select(*by, F.col("_c"), (F.col("_y") == F.col("_c")).cast("int").alias("y"), "p")
    return _group(roc_auc(long, "y", "p", [*by, "_c"]), by).agg(F.avg("auc").alias("auc"))


def class_f1(df: DataFrame, y: str, label: str, by=()) -> DataFrame:
    """class, f1 and support from confusion counts."""
    n = df.groupBy(*by, F.col(y).alias("_y"), F.col(label).alias("_l")).agg(F.count("*").alias("n"))
    side = n.select(*by, F.explode(F.array(F.struct(F.col("_y").alias("cls"), (F.col("_y") == F.col("_l")).cast("long").alias("tp"), F.lit(1).cast("long").alias("real"), F.lit(0).cast("long").alias("said")), F.struct(F.col("_l").alias("cls"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("real"), F.lit(1).cast("long").alias("said")))).alias("s"), "n")
    got = side.groupBy(*by, F.col("s.cls").alias("cls")).agg(*[F.sum(F.col(f"s.{c}") * F.col("n")).alias(c) for c in ("tp", "real", "said")])
    return got.select(*by, "cls", f1_counts(F.col("tp"), F.col("said") - F.col("tp"), F.col("real") - F.col("tp")).alias("f1"), F.col("real").alias("support"))


def macro_f1(df: DataFrame, y: str, label: str, by=()) -> DataFrame:
    return _group(class_f1(df, y, label, by), by).agg(F.avg("f1").alias("macro_f1"), (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def log_loss(df: DataFrame, y: str = "y", p: str = "p", by=(), eps: float = 1e-15) -> DataFrame:
    q = F.least(F.greatest(F.when(F.col(y) == 1, F.col(p)).otherwise(1 - F.col(p)), F.lit(eps)), F.lit(1.0))
    return _group(df, by).agg(F.avg(-F.log(q)).alias("log_loss"))


def errors(df: DataFrame, y: str = "y", p: str = "p", by=()) -> DataFrame:
    """rmse, mse, mae, rmsle, r2 and mape (null without a non-zero target)."""
    d = F.col(y) - F.col(p)
    logs = F.log1p(F.greatest(F.col(y), F.lit(0.0))) - F.log1p(F.greatest(F.col(p), F.lit(0.0)))
    ss = F.when(F.min(y) < F.max(y), F.var_pop(y) * F.count(y))
    return _group(df, by).agg(
        F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(d * d).alias("mse"), F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(logs * logs)).alias("rmsle"),
        (1 - F.try_divide(F.sum(d * d), ss)).alias("r2"), F.avg(F.when(F.col(y) != 0, F.abs(d / F.when(F.col(y) != 0, F.col(y))))).alias("mape"),
    )


def accuracy(df: DataFrame, y: str, label: str, by=()) -> DataFrame:
    return _group(df, by).agg(F.avg((F.col(y) == F.col(label)).cast("double")).alias("accuracy"))


def score(df: DataFrame, task: str, metric: str | None = None, y: str = "y", p: str = "p", by=(), probabilities: bool = True) -> DataFrame:
    """Column `score`. Default: AUC or F1 for classes, RMSE for numbers."""
    name = (metric or ("auc" if probabilities else "f1") if task == "classification" else metric or "rmse").lower().replace("-", "_")
    if name in ("rmse", "mse", "mae", "r2", "rmsle", "mape"):
        out = errors(df, y, p, by)
    elif name == "auc":
        out = roc_auc(df, y, p, by)
    elif name == "f1":
        out = best_threshold(df, y, p, by) if probabilities else f1_at(df, 0.5, y, p, by)
    elif name == "accuracy":
        out = accuracy(df.withColumn("_l", (F.col(p) >= 0.5).cast("int")), y, "_l", by)
    else:
        name, out = "log_loss", log_loss(df, y, p, by)
    return out.select(*by, F.col(name).alias("score"))
