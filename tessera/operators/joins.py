"""Joins of features, dimensions, history and grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W


def enrich(base: DataFrame, aggregates: list[tuple[DataFrame, str]], fill: float = 0.0, protect=()) -> DataFrame:
    """Left joins of per-key aggregates; the new columns' nulls become `fill`.
    Adaptive execution broadcasts an aggregate whose measured size allows it."""
    new = []
    for dim, key in aggregates:
        new += [c for c in dim.columns if c != key and c not in protect]
        base = base.join(dim, key, "left")
    return base.fillna(fill, subset=new)


def enrich_dim(base: DataFrame, dim: DataFrame, key: str, columns: list[str], suffix: str, order: str) -> DataFrame:
    """Left join on the first row by `order` of each key, so `base` keeps its
    row count; a column that `base` has already gets the suffix."""
    first = dim.groupBy(key).agg(*[F.min_by(c, order).alias(c + suffix if c in base.columns else c) for c in columns])
    return base.join(first, key, "left")


def map_lookup(df: DataFrame, column: str, aliases: DataFrame, ids: DataFrame, fallback: DataFrame, out: str) -> DataFrame:
    """alias -> canonical name -> id, with a second map for names not found.
    aliases: alias, canonical. ids and fallback: name, id."""
    named = df.join(aliases.select(F.col("alias").alias(column), "canonical"), column, "left").withColumn("_name", F.coalesce("canonical", column))
    named = named.join(ids.select(F.col("name").alias("_name"), F.col("id").alias("_id")), "_name", "left")
    named = named.join(fallback.select(F.col("name").alias("_name"), F.col("id").alias("_id2")), "_name", "left")
    return named.withColumn(out, F.coalesce("_id", "_id2")).drop("_name", "_id", "_id2", "canonical")


def history_rate(base: DataFrame, events: DataFrame, key: str, t: str, home: str, away: str, outcome: Column) -> DataFrame:
    """Mean outcome of the key over events strictly before the row's period, on
    either side, and has_history. `outcome`: 1 home wins, 0.5 draw, 0 away wins.

    Both sides are stacked, summed by key and period, and run through one
    cumulative window over periods, so no row meets each earlier event."""
    sides = events.select(F.col(home).alias(key), F.col(t), outcome.alias("_o")).unionAll(events.select(F.col(away).alias(key), F.col(t), (1 - outcome).alias("_o")))
    per = sides.groupBy(key, t).agg(F.sum("_o").alias("_s"), F.count("*").alias("_n"))
    wanted = base.select(key, t).distinct()
    both = per.unionByName(wanted.withColumns({"_s": F.lit(0.0), "_n": F.lit(0).cast("long")})).groupBy(key, t).agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    before = W.partitionBy(key).orderBy(t).rowsBetween(W.unboundedPreceding, -1)
    rate = both.select(key, t, F.sum("_s").over(before).alias("_s"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"))
    rate = rate.select(key, t, F.when(F.col("_n") > 0, F.col("_s") / F.col("_n")).alias("rate"), (F.col("_n") > 0).alias("has_history"))
    return base.join(rate, [key, t], "left")


def align_to_sample(pred: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """One row per sample row, in its order by row_id; no prediction, null."""
    return sample.join(pred, key, "left").orderBy("row_id")


def attach_columns(df: DataFrame, other: DataFrame, row_id: str) -> DataFrame:
    """Columns of `other` by explicit row id; the two must have the same rows."""
    a, b = df.count(), other.count()
    if a != b:
        raise ValueError(f"{a} rows against {b}")
    return df.join(other, row_id)


def id_mismatch(sub: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """Ids that only one of the two has, and which."""
    extra = sub.join(sample, key, "left_anti").select(key, F.lit("extra").alias("issue"))
    return extra.unionByName(sample.join(sub, key, "left_anti").select(key, F.lit("missing").alias("issue")))


def exclude_blocked(candidates: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    return candidates.join(failed.filter("do_not_retry").select(key), key, "left_anti")


def nearest_valid_cell(points: DataFrame, cells: DataFrame, rows: int, cols: int, max_radius: int = 10) -> DataFrame:
    """points: id, row, col; cells: row, col, value (null: not valid). The cell of
    the point, clamped to the grid; else the first valid one over growing square
    rings, in the order radius, row step, column step.

    Only unresolved points are expanded, by a fixed table of ring offsets."""
    own = points.withColumns({"row": F.least(F.greatest("row", F.lit(0)), F.lit(rows - 1)), "col": F.least(F.greatest("col", F.lit(0)), F.lit(cols - 1))})
    valid = cells.filter("value IS NOT NULL")
    hit = own.join(valid, ["row", "col"], "left")
    side = range(-max_radius, max_radius + 1)
    steps = sorted((max(abs(r), abs(c)), r, c) for r in side for c in side if r or c)
    offsets = F.array(*[F.struct(F.lit(k).alias("radius"), F.lit(r).alias("dr"), F.lit(c).alias("dc")) for k, r, c in steps])
    open_ = hit.filter("value IS NULL").select("id", "row", "col", F.explode(offsets).alias("o"))
    near = open_.select("id", (F.col("row") + F.col("o.dr")).alias("row"), (F.col("col") + F.col("o.dc")).alias("col"), "o").join(valid, ["row", "col"])
    best = near.groupBy("id").agg(F.min_by(F.struct("value", "o.radius"), "o").alias("b")).select("id", F.col("b.value").alias("_v"), F.col("b.radius").alias("_r"))
    return hit.join(best, "id", "left").select("id", F.coalesce("value", "_v").alias("value"), F.when(F.col("value").isNotNull(), 0).otherwise(F.col("_r")).alias("radius"))


def coalesce_sources(primary: DataFrame, fallback: DataFrame, key: str, fields: list[str], inverted: dict[str, str] | None = None) -> DataFrame:
    """Per-field merge of two records; the primary's value wins unless null.
    `{field}_source` says which gave it. `inverted`: a field of the fallback
    that holds the opposite flag."""
    inverted = inverted or {}
    other = fallback.select(key, *[(~F.col(inverted[f]) if f in inverted else F.col(f)).alias(f"_{f}") for f in fields])
    both = primary.join(other, key, "full")
    source = lambda f: F.when(F.col(f).isNotNull(), "primary").when(F.col(f"_{f}").isNotNull(), "fallback")
    extra = [c for c in primary.columns if c != key and c not in fields]
    return both.select(key, *[F.coalesce(f, f"_{f}").alias(f) for f in fields], *[source(f).alias(f"{f}_source") for f in fields], *extra)
