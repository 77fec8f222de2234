"""Window and ranking operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W


def average_rank(df: DataFrame, column: str, by: list[str] = (), out: str = "rank") -> DataFrame:
    """Rank with ties averaged: running sums over the counts of distinct values."""
    n = running(df.groupBy(*by, column).agg(F.count("*").alias("_n")), column, {"_upto": "_n"}, by)
    ranks = n.select(*by, column, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(out))
    keep = [F.col(f"a.{c}") for c in df.columns]
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*by, column)]
    return df.alias("a").join(ranks.alias("r"), on).select(*keep, out)


#: Slices of a column's range that running sums are cut into.
SLICES = 256


def running(values: DataFrame, column: str, sums: dict[str, str], by=()) -> DataFrame:
    """`values`, a row for each value of a number column within `by`, with running
    sums over it (new name -> summed column). The range is cut at approximate
    quantiles, sums of slices run first, and a window holds a slice only."""
    cuts = values.agg(F.percentile_approx(column, [k / SLICES for k in range(1, SLICES)], 10 * SLICES).alias("_cuts"))
    cut = values.crossJoin(F.broadcast(cuts)).withColumn("_s", F.coalesce(F.size(F.filter("_cuts", lambda c: F.col(column) >= c)), F.lit(0))).drop("_cuts")
    per = cut.groupBy(*by, "_s").agg(*[F.sum(c).alias(f"{o}_per") for o, c in sums.items()])
    before = W.partitionBy(*by).orderBy("_s")
    per = per.select(*by, "_s", *[(F.sum(f"{o}_per").over(before) - F.col(f"{o}_per")).alias(f"{o}_skip") for o in sums])
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*by, "_s")]
    both = cut.alias("a").join(per.alias("b"), on).select("a.*", *[f"{o}_skip" for o in sums])
    inner = W.partitionBy(*by, "_s").orderBy(column)
    return both.withColumns({o: F.col(f"{o}_skip") + F.sum(c).over(inner) for o, c in sums.items()}).drop("_s", *[f"{o}_skip" for o in sums])


def factorize(df: DataFrame, columns: list[str], row_id: str) -> DataFrame:
    """Integer codes by first appearance in row_id order; null is -1."""
    from tessera.operators.ledger import numbered

    for c in columns:
        first = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.min(row_id).alias("_at"))
        codes = numbered(first, "_code", ["_at", c], start=-1).select(c, F.col("_code").cast("int"))
        df = df.join(codes, c, "left").withColumn(c, F.coalesce("_code", F.lit(-1))).drop("_code")
    return df


def label_encode(df: DataFrame, column: str, out: str) -> DataFrame:
    """Integer code by sorted string value."""
    from tessera.operators.ledger import numbered

    values = df.select(F.col(column).cast("string").alias("_v")).filter("_v IS NOT NULL").distinct()
    codes = numbered(values, out, ["_v"], start=-1).select("_v", F.col(out).cast("int"))
    return df.join(codes, F.col(column).cast("string") == F.col("_v"), "left").drop("_v")


def group_fallback(df: DataFrame, group: str, t: str, column: str, default: float = 0.35) -> DataFrame:
    """Fill a null by the mean of values known in its group up to its period,
    else in all groups up to it, else `default`.

    Only values known at the start count, so the result has no row order. Periods
    of any type are numbered in order by range slices; sums by group and period,
    and by period, then run over slices of the numbers, so no window holds all
    periods of all groups, nor all of a group that has them all. Rows without a
    period come first, as in one of their own."""
    from tessera.operators.ledger import numbered

    periods = numbered(df.select(F.col(t).alias("_t")).distinct(), "_k", ["_t"])
    coded = df.join(periods, F.col(t).eqNullSafe(F.col("_t"))).drop("_t")
    known = coded.groupBy(group, "_k").agg(F.coalesce(F.sum(column), F.lit(0.0)).alias("_sum"), F.count(column).alias("_c"))
    per = running(known, "_k", {"_gs": "_sum", "_gn": "_c"}, [group]).select(F.col(group).alias("_g"), F.col("_k").alias("_gk"), "_gs", "_gn")
    every = running(known.groupBy("_k").agg(F.sum("_sum").alias("_sum"), F.sum("_c").alias("_c")), "_k", {"_as": "_sum", "_an": "_c"}).select(F.col("_k").alias("_ak"), "_as", "_an")
    full = coded.join(per, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_k") == F.col("_gk"))).join(every, F.col("_k") == F.col("_ak"))
    filled = F.coalesce(column, F.when(F.col("_gn") > 0, F.col("_gs") / F.col("_gn")), F.when(F.col("_an") > 0, F.col("_as") / F.col("_an")), F.lit(default))
    return full.select(*[filled.alias(c) if c == column else F.col(c) for c in df.columns])


def rank_features(imp: DataFrame, by: list[str] = ()) -> DataFrame:
    """Importance from large to small, names in order on ties."""
    return imp.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("importance"), "feature")))


def rank_candidates(scores: DataFrame, direction: str, top_n: int = 3, by: list[str] = ()) -> DataFrame:
    first = F.desc("score") if direction == "maximize" else F.asc("score")
    return scores.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(first, "branch"))).filter(F.col("rank") <= top_n)


def dedupe_first(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row by `order` of each key. A struct of the row is the
    aggregate's value, so copies are dropped before they are shuffled."""
    row = F.struct(*df.columns)
    return df.groupBy(key.alias("_k")).agg(F.min_by(row, order).alias("_r")).select("_r.*")


def month_delta(df: DataFrame, by: list[str], t: str, column: str) -> DataFrame:
    return df.withColumn("delta", F.col(column) - F.lag(column).over(W.partitionBy(*by).orderBy(t)))


def temporal_features(df: DataFrame, key: str, ts: str, column: str, lags: list[int], windows: list[int], tie: str) -> DataFrame:
    """Lags, means of the `w` rows before, and seconds since the row before."""
    w = W.partitionBy(key).orderBy(ts, tie)
    new = {f"{column}_lag{k}": F.lag(column, k).over(w) for k in lags}
    new |= {f"{column}_mean{k}": F.avg(column).over(w.rowsBetween(-k, -1)) for k in windows}
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    new["since"] = at / 1e6 - F.lag(at).over(w) / 1e6
    return df.withColumns(new)


def group_features(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Mean, std and count of features within the group."""
    return df.join(group_sums(df, group, columns), group, "left")


def group_sums(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    return df.groupBy(group).agg(F.count("*").alias("group_n"), *[x for c in columns for x in (F.avg(c).alias(f"{c}_group_mean"), F.stddev_samp(c).alias(f"{c}_group_std"))])


def group_target_mean(df: DataFrame, group: str, y: str, fold: str) -> DataFrame:
    """Mean target of the group over the other folds: totals less the own fold."""
    per = df.groupBy(group, fold).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
    g, f, a = W.partitionBy(group), W.partitionBy(fold), W.partitionBy()
    # a row for each group and fold; the overall mean stands in for groups seen in one fold only
    totals = per.groupBy(fold).agg(F.sum("_s").alias("_fs"), F.sum("_n").alias("_fn"))
    totals = totals.select(fold, ((F.sum("_fs").over(a) - F.col("_fs")) / (F.sum("_fn").over(a) - F.col("_fn"))).alias("_other"))
    out = per.select(group, fold, (F.sum("_s").over(g) - F.col("_s")).alias("_s"), (F.sum("_n").over(g) - F.col("_n")).alias("_n")).join(totals, fold)
    out = out.select(group, fold, F.coalesce(F.try_divide("_s", "_n"), "_other").alias(f"{group}_target_mean"))
    return df.join(out, [group, fold], "left")


def top_confidence(df: DataFrame, p: str, fraction: float = 0.10) -> DataFrame:
    """Rows within the top share by distance from 0.5; the cut is an exact
    percentile, so no window orders all rows."""
    from tessera.operators.profile import quantiles

    c = F.abs(F.col(p) - 0.5)
    [cut] = quantiles(df, {"c": c}, [1 - fraction])["c"]
    return df.filter(c >= cut if cut is not None else F.lit(False))
