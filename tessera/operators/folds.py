"""Cross-validation folds: deterministic, by hashes with id tie-breaks."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from tessera.operators.profile import quantiles

# Names of fold schemes as they are written in configurations.
SCHEMES = {
    "kfold": "kfold", "shufflesplit": "kfold", "stratified": "stratified", "stratifiedkfold": "stratified", "group": "group", "groupkfold": "group",
    "spatial": "group", "time": "time", "timeseries": "time", "timeseriessplit": "time", "temporal": "time",
}
#: Groups with more than one in GREEDY_GROUPS of all rows, so fewer than that, are
#: dealt greedily on the driver (their sizes only).
GREEDY_GROUPS = 100_000


def scheme(name: str) -> str:
    return SCHEMES[name.lower().replace("_", "").replace("-", "").replace(" ", "")]


def position(df: DataFrame, by: list[str], order: list, out: str, bits: int = 12) -> DataFrame:
    """Place (from 0) of each row within `by` in the order of a leading hex text
    order[0] and ties after it. Counts per slice of that text are summed over
    slices and rows ranked inside a slice, so no task ranks a whole group."""
    lead, slice_ = order[0], f"_{out}_slice"
    cut = df.withColumn(slice_, F.conv(F.substring(lead, 1, bits // 4), 16, 10).cast("int"))
    n = cut.groupBy(*by, slice_).agg(F.count("*").alias("_n"))
    skip = n.select(*by, slice_, (F.sum("_n").over(W.partitionBy(*by).orderBy(slice_)) - F.col("_n")).alias("_skip"))
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (*by, slice_)]
    both = cut.alias("a").join(skip.alias("s"), on).select("a.*", "_skip")
    inner = F.row_number().over(W.partitionBy(*by, slice_).orderBy(*order))
    return both.withColumn(out, F.col("_skip") + inner - 1).drop("_skip", slice_)


def assign_folds(df: DataFrame, kind: str, n: int, seed: int, key: str, group: str | None = None, y: str | None = None, ts: str | None = None) -> DataFrame:
    """Column `fold` (0..n-1). kfold: equal shuffled folds. stratified: equal
    class shares. group: a group stays together. time: n + 1 tiles in time
    order, numbered -1..n-1; fold f trains on tiles before it."""
    kind = scheme(kind)
    if kind == "group":
        if group is None:
            raise ValueError("group folds need a group column")
        return group_folds(df, group, n)
    if kind == "time":
        return time_folds(df, ts, key, n)
    by = [y] if kind == "stratified" else []
    hashed = df.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}"))))
    placed = position(hashed, by, ["_h", key], "_k")
    return placed.withColumn("fold", F.pmod("_k", F.lit(n)).cast("int")).drop("_h", "_k")


def group_folds(df: DataFrame, group: str, n: int) -> DataFrame:
    """Largest groups first to the lightest fold, down to those of one in
    GREEDY_GROUPS of the rows; smaller ones fill the folds up to one level by
    running sums in a hashed order."""
    spark = df.sparkSession
    sizes = df.groupBy(group).agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    large = F.col("n") * GREEDY_GROUPS > total
    loads = [(0, f) for f in range(n)]
    rows = []
    for r in sorted(sizes.filter(large).collect(), key=lambda r: (-r["n"], str(r[0]))):
        load, f = heapq.heappop(loads)
        rows.append((r[0], f))
        heapq.heappush(loads, (load + r["n"], f))
    folds = spark.createDataFrame(rows, sizes.select(group).withColumn("fold", F.lit(0)).schema)
    if left := total - sum(load for load, _ in loads):
        folds = folds.unionByName(filled(sizes.filter(~large), group, room(sorted(loads), left)))
    folds = folds.withColumnRenamed(group, "_group")
    return df.join(folds, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


def room(loads: list[tuple[int, int]], left: int) -> list[float]:
    """Rows of `left` that each fold takes, when the lightest are filled to one
    level. loads: (load, fold), from small to large."""
    for k in range(len(loads), 0, -1):
        level = (sum(load for load, _ in loads[:k]) + left) / k
        if level >= loads[k - 1][0]:
            break
    out = {f: max(0.0, level - load) for load, f in loads}
    return [out[f] for f in sorted(out)]


def filled(sizes: DataFrame, group: str, rooms: list[float], slices: int = 4096) -> DataFrame:
    """group and fold: groups in a hashed order, cut where the rooms of the folds
    end. Sums run over slices first, so no task ranks all groups."""
    cut = sizes.withColumn("_slice", F.pmod(F.xxhash64(group), F.lit(slices)))
    per = cut.groupBy("_slice").agg(F.sum("n").alias("_n"))
    skip = per.select("_slice", (F.sum("_n").over(W.orderBy("_slice")) - F.col("_n")).alias("_skip"))
    inner = F.sum("n").over(W.partitionBy("_slice").orderBy(group).rowsBetween(W.unboundedPreceding, 0))
    ends = [sum(rooms[: k + 1]) for k in range(len(rooms) - 1)]
    placed = cut.join(F.broadcast(skip), "_slice").withColumn("_at", F.col("_skip") + inner - F.col("n") / 2)
    fold = F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: F.col("_at") >= e)) if ends else F.lit(0)
    return placed.select(group, fold.alias("fold"))


def time_folds(df: DataFrame, ts: str, key: str, n: int) -> DataFrame:
    """Tiles of equal size in time order, cut at exact quantiles of the time."""
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    cuts = [c for c in quantiles(df, {"t": t}, [k / (n + 1) for k in range(1, n + 1)])["t"] if c is not None]
    tile = sum(((t >= c).cast("int") for c in cuts), F.lit(-1))
    return df.withColumn("fold", tile.cast("int"))


def spatial_blocks(df: DataFrame, lat: str, lon: str, n: int, seed: int = 0) -> DataFrame:
    """k-means clusters on the unit sphere, min(max(3n, n + 1), places) of them in
    column block, dealt to folds as groups; the best of ten starts by cost. Fewer
    places than folds are an error. Rows are counted by place once and the ten
    starts share each scan of the places; the nearest centre is an expression.
    Rows without a place are a block of their own."""
    from tessera.functions.scalar import unit_sphere
    from tessera.operators.clustering import k_means
    from tessera.sources.shared import stored

    axes = ["_x", "_y", "_z"]
    points = df.withColumns(dict(zip(axes, unit_sphere(lat, lon))))
    places, _ = stored(points.dropna(subset=axes).groupBy(*axes).agg(F.count("*").alias("w")).withColumn("h", F.xxhash64(*axes)), "places")
    k = min(max(3 * n, n + 1), places.count())
    if k < n:
        raise ValueError(f"{k} distinct places for {n} folds")
    centres, _, _ = k_means(places, axes, k, seed)
    far = F.array(*[sum((F.col(c) - float(v)) * (F.col(c) - float(v)) for c, v in zip(axes, centre)) for centre in centres])
    block = F.when(F.col("_x").isNotNull() & F.col("_y").isNotNull() & F.col("_z").isNotNull(), F.array_position(far, F.array_min(far)).cast("int") - 1)
    return group_folds(points.withColumn("block", block).drop(*axes), "block", n)


def folds_by_profile(df: DataFrame, profile: dict, n: int, seed: int, key: str, y: str | None = None, ts: str | None = None, lat: str | None = None, lon: str | None = None) -> tuple[str, DataFrame]:
    """(scheme used, df with folds) as `choose_cv` says. Spatial groups that cannot
    be built, for want of places or columns, give way to stratified folds for a
    rare class, else to plain ones."""
    kind = choose_cv(profile, profile.get("config"))
    group = profile.get("group")
    if kind == "group" and group is None:
        try:
            if lat is None or lon is None:
                raise ValueError("no columns of places")
            return "spatial", spatial_blocks(df, lat, lon, n, seed)
        except ValueError:
            kind = choose_cv({"minority": profile.get("minority")})
    if kind == "stratified" and y is None:
        kind = "kfold"
    return kind, assign_folds(df, kind, n, seed, key, group=group, y=y, ts=ts)


def choose_cv(profile: dict, config: str | None = None) -> str:
    """Configured name, else: temporal, group or spatial (with five points at
    least), stratified if the minority is below .15, else kfold."""
    if config:
        return scheme(config)
    if profile.get("temporal"):
        return "time"
    if profile.get("group") or (profile.get("spatial") and profile.get("points", 0) >= 5):
        return "group"
    return "stratified" if profile.get("minority") is not None and profile["minority"] < 0.15 else "kfold"


def strategy_id(config: str | None = None, override: str | None = None) -> str:
    return f"override:{override}" if override else f"config:{config}" if config else "unknown"


def fold_train(df: DataFrame, fold: int) -> DataFrame:
    """Pseudo-labelled rows are in every training side."""
    return df.filter((F.col("fold") != fold) | F.col("is_pseudo"))


def fold_valid(df: DataFrame, fold: int) -> DataFrame:
    """and in no validation side."""
    return df.filter((F.col("fold") == fold) & ~F.col("is_pseudo"))


def audit_oof_tags(oof: DataFrame, active: str) -> DataFrame:
    """branch and tag of rows whose tag, prefixes off, is empty or not the active one."""
    from tessera.functions.scalar import strip_strategy_prefix

    tag = strip_strategy_prefix(F.coalesce("cv_strategy_id", F.lit("")))
    return oof.withColumn("tag", tag).filter((tag == "") | ~tag.isin(active, "unknown")).groupBy("branch", "tag").agg(F.count("*").alias("n"))


def check_folds(valid: DataFrame, key: str) -> DataFrame:
    """Ids that are not validated exactly once."""
    return valid.groupBy(key).agg(F.count("*").alias("n")).filter("n <> 1")
