"""Profiles of tables: one aggregate pass over all columns wherever it can be."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from tessera.operators.moments import pair_correlations
from tessera.operators.select import numeric_columns, string_columns
from tessera.operators.windows import running

CHUNK = 100  # aggregates of one pass, so that a wide table makes no huge plan


def flat(c: str | Column) -> Column:
    """One value only. Merged sums of squares do not tell: adding up parts of 49
    equal rows leaves a spread of rounding."""
    return F.min(c) == F.max(c)


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows with both values; null without spread. (`corr`
    raises on a column without spread in ANSI mode.)"""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.when(~flat(a) & ~flat(b), F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))


def unpivot(df: DataFrame, columns: list[str], keep: list[str] = (), name: str = "column", value: str = "value") -> DataFrame:
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(list(keep), columns, name, value)


def per_column(df: DataFrame, columns: list[str], exprs) -> DataFrame:
    """A row for each column from one pass: `exprs(c)` gives (name, aggregate)
    pairs that are alike for all columns."""
    parts = []
    for i in range(0, len(columns), CHUNK):
        own = columns[i : i + CHUNK]
        one = df.agg(*[F.struct(F.lit(c).alias("column"), *[e.alias(n) for n, e in exprs(c)]).alias(f"s{k}") for k, c in enumerate(own)])
        parts.append(one.select(F.explode(F.array(*[f"s{k}" for k in range(len(own))])).alias("s")).select("s.*"))
    return reduce(DataFrame.unionByName, parts)


def entity_aggregates(df: DataFrame, key: str | list[str], measures: dict[str, list[str]], flags: dict[str, tuple[str, Column]] | None = None) -> DataFrame:
    """count, then sum/avg/min/max of measures, then conditional sums by flag."""
    keys = [key] if isinstance(key, str) else key
    made = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}
    out = [F.count("*").alias("n")] + [made[f](c).alias(f"{c}_{f}") for c, fs in measures.items() for f in fs]
    out += [F.sum(F.when(test, F.col(c)).otherwise(0.0)).alias(name) for name, (c, test) in (flags or {}).items()]
    return df.groupBy(*keys).agg(*out)


def target_balance(df: DataFrame, y: str) -> DataFrame:
    n = df.groupBy(F.col(y).alias("value")).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("t"), F.max("n").alias("m"))
    return n.crossJoin(F.broadcast(total)).select("value", "n", (F.col("n") / F.col("t")).alias("share"), (F.col("m") / F.col("t")).alias("majority_share"))


def null_profile(df: DataFrame) -> DataFrame:
    return per_column(df, df.columns, lambda c: [("nulls", F.sum(F.col(c).isNull().cast("long"))), ("null_rate", F.avg(F.col(c).isNull().cast("double")))])


def variance_profile(df: DataFrame, near: float = 0.01) -> DataFrame:
    out = per_column(df, numeric_columns(df), lambda c: [("variance", F.var_samp(c) * F.when(flat(c), 0.0).otherwise(1.0))])
    return out.withColumns({"zero": F.col("variance") == 0, "near_zero": F.col("variance") < near})


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns with one distinct value, null included; min and max need no distinct."""
    n = per_column(df, df.columns, lambda c: [("one", F.coalesce(F.min(c) == F.max(c), F.lit(True)) & ((F.count(c) == F.count("*")) | (F.count(c) == 0)))])
    return n.filter("one").select("column")


def high_corr_pairs(df: DataFrame, threshold: float = 0.95, columns: list[str] | None = None) -> DataFrame:
    """Upper-triangle pairs of abs Pearson above the threshold, pairwise complete."""
    return pair_correlations(df, columns or numeric_columns(df), threshold)


def target_correlation(df: DataFrame, y: str, columns: list[str]) -> DataFrame:
    """Pearson with the target over complete pairs, null unless more than two."""
    both = lambda c: F.col(c).isNotNull() & F.col(y).isNotNull()
    return per_column(df, columns, lambda c: [("r", F.when(F.sum(both(c).cast("int")) > 2, pearson(F.col(c), F.col(y))))])


def adjusted_skewness(c: str) -> Column:
    n = F.count(c)
    return F.when((n >= 3) & ~flat(c), F.skewness(c) * F.sqrt(n * (n - 1.0)) / (n - 2))


#: Distinct values that an exact percentile of Spark gathers in one task at most.
MOST_VALUES = 1_000_000


def quantiles(df: DataFrame, exprs: dict[str, Column], probs: list[float], most: int = MOST_VALUES) -> dict[str, list]:
    """Exact interpolated quantiles of each expression, None without values.

    Columns of at most `most` distinct values by estimate take Spark's
    percentile. Of others only the values next to each quantile are looked for,
    see `order_statistics`, so no task holds a column's distinct values."""
    if not exprs:
        return {}
    names = {f"q{k}": n for k, n in enumerate(exprs)}
    rows = df.select(*[exprs[n].cast("double").alias(a) for a, n in names.items()])
    sizes = rows.agg(*[F.count(a).alias(f"{a}_n") for a in names], *[F.approx_count_distinct(a).alias(f"{a}_d") for a in names]).first()
    few = [a for a in names if sizes[f"{a}_d"] <= most]
    one = rows.agg(F.count(F.lit(1)), *[F.percentile(a, probs).alias(a) for a in few]).first()
    out = {names[a]: list(one[a] or [None] * len(probs)) for a in few}
    for a in set(names) - set(few):
        at = [p * (sizes[f"{a}_n"] - 1) for p in probs]
        found = order_statistics(rows.select(a).filter(F.col(a).isNotNull()), a, sizes[f"{a}_n"], {r for x in at for r in (int(x), min(int(x) + 1, sizes[f"{a}_n"] - 1))}, most)
        out[names[a]] = [found[int(x)] + (x - int(x)) * (found[min(int(x) + 1, sizes[f"{a}_n"] - 1)] - found[int(x)]) for x in at]
    return out


def order_statistics(rows: DataFrame, c: str, n: int, ranks: set[int], most: int) -> dict[int, float]:
    """Values at `ranks` (from 0) of the sorted column. Each rank is bracketed by
    approximate percentiles; what lies below and inside is counted, and the
    bracket narrowed until it has at most `most` distinct values. Those are
    counted by value, and the running count gives the rank."""
    spans = {r: (None, None, 0, n, 1 / 500) for r in sorted(ranks)}  # low, high, rows below and inside, slack
    done: dict[int, tuple] = {}
    inside = lambda lo, hi: F.lit(True) if lo is None else F.col(c).between(lo, hi)
    while spans:
        share = {r: (r - below) / max(1, size - 1) for r, (_, _, below, size, _) in spans.items()}
        edges = rows.agg(*[F.percentile_approx(F.when(inside(lo, hi), F.col(c)), [max(0.0, share[r] - e), min(1.0, share[r] + e)], 10_000).alias(f"r{r}") for r, (lo, hi, _, _, e) in spans.items()]).first()
        counts = rows.agg(*[x for r in spans for lo, hi in [edges[f"r{r}"]] for x in (F.count_if(F.col(c) < lo).alias(f"b{r}"), F.count_if(inside(lo, hi)).alias(f"i{r}"), F.approx_count_distinct(F.when(inside(lo, hi), F.col(c))).alias(f"d{r}"))]).first()
        for r, (lo, hi, below, size, e) in list(spans.items()):
            b, i, d = counts[f"b{r}"], counts[f"i{r}"], counts[f"d{r}"]
            if not b <= r < b + i:
                spans[r] = lo, hi, below, size, 4 * e
            elif d <= most or i == size:
                done[r] = (*edges[f"r{r}"], b)
                del spans[r]
            else:
                spans[r] = *edges[f"r{r}"], b, i, 1 / 500
    out = {}
    for r, (lo, hi, below) in done.items():
        values = rows.filter(inside(lo, hi)).groupBy(c).agg(F.count("*").alias("n"))
        upto = values.select(c, (F.sum("n").over(W.orderBy(c)) + below).alias("upto"))
        out[r] = upto.filter(F.col("upto") > r).agg(F.min(c)).first()[0]
    return out


def outlier_summary(df: DataFrame, columns: list[str] | None = None, most: float = 0.05) -> DataFrame:
    """Outliers of each column by the rule that its shape asks for.

    abs skew >= 1: modified z of the median deviation above 3.5 (mad), or any
    deviation if that is 0 (median_deviation). Else fences of 1.5 quartile
    ranges (iqr), or percentiles 1 and 99 if that is 0 (quantile_fence). Empty:
    method empty. Share is of all rows; flagged above `most`."""
    columns = columns or numeric_columns(df)
    first = {r["column"]: r for r in per_column(df, columns, lambda c: [("n", F.count(c)), ("rows", F.count("*")), ("skew", adjusted_skewness(c))]).collect()}
    q = quantiles(df, {c: F.col(c) for c in columns}, [0.01, 0.25, 0.5, 0.75, 0.99])
    skewed = [c for c in columns if first[c]["n"] and abs(first[c]["skew"] or 0) >= 1]
    mad = {c: v[0] for c, v in quantiles(df, {c: F.abs(F.col(c) - q[c][2]) for c in skewed}, [0.5]).items()}

    def rule(c):
        f = first[c]
        if not f["n"]:
            return "empty", F.lit(False)
        p1, q1, med, q3, p99 = q[c]
        if c in mad:
            return ("mad", 0.6745 * F.abs(F.col(c) - med) / mad[c] > 3.5) if mad[c] else ("median_deviation", F.col(c) != med)
        span = q3 - q1
        return ("iqr", (F.col(c) < q1 - 1.5 * span) | (F.col(c) > q3 + 1.5 * span)) if span else ("quantile_fence", (F.col(c) < p1) | (F.col(c) > p99))

    rules = {c: rule(c) for c in columns}
    out = per_column(df, columns, lambda c: [("method", F.lit(rules[c][0])), ("outliers", F.count_if(rules[c][1])), ("share", F.count_if(rules[c][1]) / F.count("*"))])
    return out.withColumn("flagged", F.col("share") > most)


def scale_audit(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Flag a spread (p95 - p5) above 1000 or a deviation above ten median sizes."""
    columns = columns or numeric_columns(df)
    ends, sizes = quantiles(df, {c: F.col(c) for c in columns}, [0.05, 0.95]), quantiles(df, {c: F.abs(F.col(c)) for c in columns}, [0.5])
    number = lambda x: F.lit(x).cast("double")
    spread = {c: number(None if lo is None else hi - lo) for c, (lo, hi) in ends.items()}
    out = per_column(df, columns, lambda c: [("spread", spread[c]), ("std", F.stddev_samp(c)), ("med", number(sizes[c][0]))])
    spread = F.col("spread")
    return out.select("column", "spread", "std", ((spread > 1000) | (F.col("std") / F.greatest("med", F.lit(1e-12)) > 10)).alias("flagged"))


def bands(df: DataFrame, columns: list[str]) -> DataFrame:
    """band, month and value of every BAND_MM column."""
    from tessera.functions.scalar import band_month

    long = unpivot(df, columns)
    return long.select(*band_month("column"), "value").filter("band IS NOT NULL")


def band_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    return bands(df, columns).groupBy("band").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))


def monthly_means(df: DataFrame, columns: list[str]) -> DataFrame:
    return bands(df, columns).groupBy("band", "month").agg(F.avg("value").alias("mean"))


def seasonal_amplitude(df: DataFrame, columns: list[str]) -> DataFrame:
    m = monthly_means(df, columns).groupBy("band").agg((F.max("mean") - F.min("mean")).alias("amplitude"), F.count("*").alias("n"))
    return m.filter("n >= 2").select("band", "amplitude")


def temporal_trends(df: DataFrame, columns: list[str]) -> DataFrame:
    m = monthly_means(df, columns)  # at most twelve rows a band
    return m.withColumn("delta", F.col("mean") - F.lag("mean").over(W.partitionBy("band").orderBy("month")))


def missingness_type(df: DataFrame, targets: list[str], least: float = 0.05) -> DataFrame:
    """none, MNAR if the null flag's correlation with a target reaches `least`, else MCAR."""
    columns = [c for c in df.columns if c not in targets]
    r = lambda c, y: F.coalesce(F.abs(pearson(F.col(c).isNull().cast("double"), F.col(y))), F.lit(0.0))
    out = per_column(df, columns, lambda c: [("nulls", F.count_if(F.col(c).isNull())), ("r", F.greatest(F.lit(0.0), *[r(c, y) for y in targets]))])
    return out.select("column", F.when(F.col("nulls") == 0, "none").when(F.col("r") >= least, "MNAR").otherwise("MCAR").alias("type"))


def categorical_inventory(df: DataFrame, rules: dict[str, str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct values, null included, and encoding of string columns and of any
    column with a rule."""
    rules = rules or {}
    columns = [c for c in df.columns if c in rules or c in string_columns(df)]
    n = F.approx_count_distinct if approximate else F.count_distinct
    out = per_column(df, columns, lambda c: [("cardinality", n(F.col(c)) + F.max(F.col(c).isNull().cast("long"))), ("rule", F.lit(rules.get(c)).cast("string"))])
    default = F.when(F.col("cardinality") <= 2, "binary").when(F.col("cardinality") <= 15, "onehot").otherwise("label")
    return out.select("column", "cardinality", F.coalesce("rule", default).alias("encoding"))


def data_sufficiency(df: DataFrame, features: int) -> DataFrame:
    ratio = F.col("n") / features
    return df.agg(F.count("*").alias("n")).select("n", ratio.alias("ratio"), F.when(ratio >= 50, "sufficient").when(ratio >= 10, "borderline").otherwise("insufficient").alias("verdict"))


def class_separability(df: DataFrame, y: str, columns: list[str]) -> DataFrame:
    """Best F1 of class 1 over one-split stumps of each column (nulls at the median).

    Counts per distinct value come first; the windows run over those."""
    med = quantiles(df, {c: F.col(c) for c in columns}, [0.5])
    long = unpivot(df.fillna({c: m for c, [m] in med.items() if m is not None}).withColumn(y, F.col(y).cast("double")), columns, [y])
    at = long.groupBy("column", "value").agg(F.count("*").alias("n"), F.sum(y).alias("pos"))
    totals = at.groupBy("column").agg(F.sum("n").alias("n"), F.sum("pos").alias("p"))
    c = running(at, "value", {"nl": "n", "pl": "pos"}, ["column"]).select("column", "value", "nl", "pl").join(F.broadcast(totals), "column")
    c = c.filter("nl < n").withColumns({"nr": F.col("n") - F.col("nl"), "pr": F.col("p") - F.col("pl")})
    side = lambda n, p: F.lit(1.0) - F.pow(p / n, 2) - F.pow(1 - p / n, 2)
    gini = (F.col("nl") * side(F.col("nl"), F.col("pl")) + F.col("nr") * side(F.col("nr"), F.col("pr"))) / F.col("n")
    says = lambda n, p: (p * 2 > n).cast("int")
    tp = says(F.col("nl"), F.col("pl")) * F.col("pl") + says(F.col("nr"), F.col("pr")) * F.col("pr")
    fp = says(F.col("nl"), F.col("pl")) * (F.col("nl") - F.col("pl")) + says(F.col("nr"), F.col("pr")) * (F.col("nr") - F.col("pr"))
    f1 = F.coalesce(F.try_divide(2 * tp, tp + fp + F.col("p")), F.lit(0.0))
    best = c.groupBy("column").agg(F.min_by(F.struct(f1.alias("f1"), F.col("value").alias("split")), F.struct(F.round(gini, 10).alias("g"), F.col("value").alias("v"))).alias("b"))
    return best.select("column", F.col("b.split").alias("split"), F.col("b.f1").alias("f1"))


def target_stats(df: DataFrame, y: str) -> DataFrame:
    return df.agg(F.min(y).alias("min"), F.max(y).alias("max"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"), F.stddev_pop(y).alias("std_pop"))


def block_prevalence(df: DataFrame, block: str, y: str) -> DataFrame:
    return df.groupBy(block).agg(F.count("*").alias("n"), F.sum((F.col(y) > 0).cast("long")).alias("positives"), F.avg(y).alias("prevalence"))


def cube_stats(cells: DataFrame) -> DataFrame:
    """Per cell and variable over time: mean, std (population), min, max."""
    v = F.col("value")
    return cells.groupBy("row", "col", "variable").agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))


def mutual_information(df: DataFrame, columns: list[str], y: str, bins: int = 10) -> DataFrame:
    """Plug-in MI of each column, cut at its deciles, with the class, in nats,
    and NMI = MI / H(y). Missing values are a bin of their own."""
    edges = {c: [e for e in q if e is not None] for c, q in quantiles(df, {c: F.col(c) for c in columns}, [k / bins for k in range(1, bins)]).items()}
    cut = {c: F.when(F.col(c).isNull(), -1).otherwise(sum((F.col(c) > e).cast("int") for e in sorted(set(edges[c] or [0.0])))) for c in columns}
    long = df.select(F.col(y).cast("string").alias("y"), *[cut[c].cast("double").alias(c) for c in columns]).unpivot(["y"], columns, "column", "bin")
    joint = long.groupBy("column", "bin", "y").agg(F.count("*").alias("n"))
    by = lambda *k: F.sum("n").over(W.partitionBy("column", *k)).cast("double")
    t = joint.select("column", "y", "bin", F.col("n").cast("double").alias("n"), by("bin").alias("nb"), by("y").alias("ny"), by().alias("t"))
    mi = F.sum(F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("nb") * F.col("ny"))))
    h = -F.sum(F.col("n") / F.col("t") * F.log(F.col("ny") / F.col("t")))
    out = t.groupBy("column").agg(mi.alias("mi"), h.alias("h"))
    return out.select("column", "mi", F.coalesce(F.try_divide("mi", "h"), F.lit(0.0)).alias("nmi"))


def infer_targets(sample: DataFrame, key: str, rows: int = 100) -> DataFrame:
    """A spec for each column beside the id: classification if its first values
    are 0/1 or lie within [0, 1], else regression; weight 1/k. A label and
    probability pair (F1 and AUC columns) is a single target."""
    columns = [c for c in sample.columns if c != key]
    one = len(columns) == 2 and {c.lower() for c in columns} in ({"targetf1", "targetauc"}, {"target_f1", "target_auc"}, {"f1", "auc"})
    own = columns[:1] if one else columns
    head = sample.orderBy(key).limit(rows)
    unit = lambda c: F.coalesce(F.bool_and(F.col(c).between(0, 1)), F.lit(False))
    out = per_column(head, own, lambda c: [("unit", unit(c))])
    return out.select("column", F.when(F.col("unit"), "classification").otherwise("regression").alias("task"), F.lit(1.0 / len(own)).alias("weight"))
