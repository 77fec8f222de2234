"""Transforms fitted on training rows and applied to both splits.

A fitted value is a scalar per column (or per column and fold): those few come
to the driver and go back into the plan as literals; rows never do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions import scalar as S
from tessera.operators.profile import flat, per_column, quantiles, target_correlation
from tessera.operators.select import numeric_columns, target_leak_guard
from tessera.operators.windows import group_sums
from tessera.sources.shared import spread, stored


def medians(df: DataFrame, columns: list[str]) -> dict:
    return {c: q[0] for c, q in quantiles(df, {c: F.col(c) for c in columns}, [0.5]).items()}


def impute(train: DataFrame, test: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Numeric median, else the smallest most frequent value, of the training rows."""
    numeric = [c for c in columns if c in numeric_columns(train)]
    other = [c for c in columns if c not in numeric]
    fill = medians(train, numeric)
    if other:
        fill |= train.agg(*[F.mode(c, True).alias(c) for c in other]).first().asDict()
    expr = lambda df: df.select(*[F.coalesce(F.col(c), F.lit(fill[c])).alias(c) if fill.get(c) is not None else F.col(c) for c in df.columns])
    return expr(train), expr(test)


def zero_fill_mnar(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna(0, subset=columns)


def clean(train: DataFrame, test: DataFrame, mnar: list[str], mcar: list[str], protect=(), zero_fill: bool = False) -> tuple[DataFrame, DataFrame, dict]:
    """Indicators of all MNAR columns first, then fills, then columns constant in
    both splits go. Returns both and what was done."""
    from tessera.operators.sets import constant_in_both

    train, test = (df.select("*", *[S.missing_indicator(c) for c in mnar]) for df in (train, test))
    if zero_fill:
        train, test = zero_fill_mnar(train, mnar), zero_fill_mnar(test, mnar)
    train, test = impute(train, test, mcar)
    dropped = constant_in_both(train, test, protect)
    return train.drop(*dropped), test.drop(*dropped), {"indicators": [f"{c}_is_missing" for c in mnar], "filled": mcar, "dropped": dropped}


def bin_of(c: str, edges: list[float]) -> Column:
    """Which of the bins between edges holds the value, the least edge in the first;
    null for a null and outside the edges."""
    if len(edges) < 2:
        return F.lit(None).cast("int")
    inner = sum(((F.col(c) > e).cast("int") for e in edges[1:-1]), F.lit(0))
    return F.when(F.col(c).between(edges[0], edges[-1]), inner)


def target_bin_mean(train: DataFrame, test: DataFrame, c: str, y: str, q: int = 10, fold: str | None = None) -> tuple[DataFrame, DataFrame]:
    """`{c}_bin_mean`: mean target of the quantile bin; the overall mean for a null,
    an empty bin and a value outside the range that the bins were fitted on. With
    `fold`, each training row gets the means of the other folds under edges of
    those (a row without a fold: of all rows); test rows those of all training
    rows. Edges and means of all folds come from the same scans, however many
    folds there are, and are few numbers, so they go into the plan as literals."""
    name, every = f"{c}_bin_mean", -1
    folds = [r[0] for r in train.select(fold).distinct().orderBy(fold).collect() if r[0] is not None] if fold else []
    sides = {every: F.lit(True)} | {k: F.col(fold) != f for k, f in enumerate(folds)}
    found = quantiles(train, {k: F.when(w, F.col(c)) for k, w in sides.items()}, [k / q for k in range(q + 1)])
    edges = {k: sorted(set(found[k]) - {None}) for k in sides}
    each = F.array(*[F.when(w, F.struct(F.lit(k).alias("side"), bin_of(c, edges[k]).alias("bin"))) for k, w in sides.items()])
    sums = train.select(F.col(y).cast("double").alias("_y"), F.explode(F.array_compact(each)).alias("s")).groupBy("s.side", "s.bin").agg(F.sum("_y").alias("t"), F.count("_y").alias("n")).collect()
    mean = {k: {r["bin"]: r["t"] / r["n"] for r in sums if r["side"] == k and r["n"]} for k in sides}
    total = {k: [sum(r[x] or 0 for r in sums if r["side"] == k) for x in ("t", "n")] for k in sides}

    def by(k) -> Column:
        overall = F.lit(total[k][0] / total[k][1] if total[k][1] else None).cast("double")
        known = {b: m for b, m in mean[k].items() if b is not None}
        if not known:
            return overall
        return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in known.items() for x in pair]), bin_of(c, edges[k])), overall)

    own = by(every)
    for k, f in enumerate(folds):
        own = F.when(F.col(fold) == f, by(k)).otherwise(own)
    return train.withColumn(name, own), test.withColumn(name, by(every))


def standardise(train: DataFrame, test: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """z-score by training mean and population deviation; a constant becomes 0."""
    fit = {r["column"]: (r["m"], r["s"]) for r in per_column(train, columns, lambda c: [("m", F.when(flat(c), F.min(c).cast("double")).otherwise(F.avg(c))), ("s", F.when(~flat(c), F.stddev_pop(c)))]).collect()}
    expr = lambda df: df.withColumns({c: (F.col(c) - m) / (s or 1.0) for c, (m, s) in fit.items() if m is not None})
    return expr(train), expr(test)


def pca_features(train: DataFrame, test: DataFrame, columns: list[str], k: int) -> tuple[DataFrame, DataFrame]:
    """pca_1..k of median-filled, scaled columns, fitted on the training rows;
    the sign makes each direction's largest loading positive."""
    from pyspark.ml.feature import PCA, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    if len(columns) < 2:
        return train, test
    k = min(k, len(columns))
    a, b = impute(train, test, columns)
    a, b = standardise(a, b, columns)
    pack = VectorAssembler(inputCols=columns, outputCol="_v", handleInvalid="keep")
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(pack.transform(a.fillna(0.0, subset=columns)))
    load = model.pc.toArray()
    sign = [1.0 if load[abs(load[:, i]).argmax(), i] >= 0 else -1.0 for i in range(k)]

    def expr(df, scaled):
        out = model.transform(pack.transform(scaled.fillna(0.0, subset=columns))).withColumn("_a", vector_to_array("_p"))
        plain = out.select(*[c for c in df.columns if c not in columns], *columns, *[(F.col("_a")[i] * sign[i]).alias(f"pca_{i + 1}") for i in range(k)])
        return plain

    return expr(train, a), expr(test, b)


def build_features(train: DataFrame, test: DataFrame, spec: dict, y: str, fold: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Columns of a declarative spec behind the base columns: polynomials,
    interactions, ratios, conditions, temporal_deltas, missingness_interactions,
    group_aggregations, target_dependent_bins, pca, aliases. Fitted on `train`.
    What names a missing column is skipped."""
    target_leak_guard(spec, y)
    have = set(train.columns) & (set(test.columns) | {y})
    new = [S.polynomial(c) for c in spec.get("polynomials", []) if c in have]
    new += [S.interaction(a, b) for a, b in spec.get("interactions", []) if {a, b} <= have]
    new += [S.ratio(a, b) for a, b in spec.get("ratios", []) if {a, b} <= have]
    new += [S.condition(c["column"], c["operator"], c["value"], c["name"]) for c in spec.get("conditions", []) if c["column"] in have]
    base = [c for c in numeric_columns(train) if c in test.columns and c not in (y, fold)]
    train, test = train.select("*", *new), test.select("*", *new)
    for band in spec.get("temporal_deltas", []):
        train, test = temporal_deltas(train, band), temporal_deltas(test, band)
    if mnar := [c for c in spec.get("missingness_interactions", []) if c in have]:
        flags = missingness_flags(train, mnar, y, [c for c in spec.get("interaction_features", base) if c in have], spec.get("interaction_top", 3))
        train, test = train.withColumns(flags), test.withColumns(flags)
    for group in (g for g in spec.get("group_aggregations", []) if g in have):
        sums = group_sums(train, group, [c for c in spec.get("aggregated", base) if c in have and c != group])
        train, test = train.join(sums, group, "left"), test.join(sums, group, "left")
    for b in spec.get("target_dependent_bins", []):
        if b["column"] in have:
            train, test = target_bin_mean(train, test, b["column"], y, b.get("q", 10), fold)
            train, test = (df.withColumnRenamed(f"{b['column']}_bin_mean", b.get("name", f"{b['column']}_bin_mean")) for df in (train, test))
    if spec.get("pca"):
        train, test = pca_features(train, test, [c for c in spec["pca"]["columns"] if c in have], spec["pca"]["k"])
    aliases = spec.get("aliases", {})
    return train.withColumnsRenamed(aliases), test.withColumnsRenamed(aliases)


def default_spec(profile: dict) -> dict:
    """Defaults of a profile: high correlation pairs, MNAR columns, bands, features."""
    spec: dict = {"polynomials": [], "interactions": [], "ratios": [], "conditions": []}
    if profile.get("bands"):
        spec["temporal_deltas"] = list(profile["bands"])
    if profile.get("features") and len(profile.get("pairs", [])) / len(profile["features"]) > 0.3:
        spec["pca"] = {"columns": list(profile["features"]), "k": min(5, len(profile["features"]))}
    if profile.get("mnar"):
        spec["missingness_interactions"] = list(profile["mnar"])
    if profile.get("group"):
        spec["group_aggregations"] = [profile["group"]]
    return spec


def merge_spec(auto: dict, operator: dict) -> dict:
    return {**auto, **operator}


def temporal_deltas(df: DataFrame, band: str) -> DataFrame:
    """{band}_delta_MM: month MM less the month before, for months that exist."""
    months = [m for m in range(2, 13) if f"{band}_{m:02d}" in df.columns and f"{band}_{m - 1:02d}" in df.columns]
    return df.withColumns({f"{band}_delta_{m:02d}": F.col(f"{band}_{m:02d}") - F.col(f"{band}_{m - 1:02d}") for m in months})


def missingness_flags(df: DataFrame, mnar: list[str], y: str, candidates: list[str], top: int) -> dict[str, Column]:
    r = {x["column"]: abs(x["r"]) for x in target_correlation(df, y, candidates).collect() if x["r"] is not None}
    best = sorted(r, key=lambda c: (-r[c], c))[:top]
    return {f"{c}_missing_x_{b}": F.col(c).isNull().cast("double") * F.col(b) for c in mnar for b in best if b != c}


def missingness_interactions(df: DataFrame, mnar: list[str], y: str, candidates: list[str], top: int) -> DataFrame:
    """Null flag of each MNAR column times each of the features nearest the target."""
    return df.withColumns(missingness_flags(df, mnar, y, candidates, top))


#: Finest cells of the unit sphere: edges of 2 ** -(LEVELS - 1), 0.8 m; and rows
#: of a cell that are compared without a look at its parts.
LEVELS, FEW = 24, 32
AXES = ("x", "y", "z")


def neighbours(rows: DataFrame, others: DataFrame, lat: str, lon: str, key: str, k: int) -> DataFrame:
    """key, other, km and place of the k nearest of all others of each row,
    itself left out."""
    from pyspark.sql.window import Window as W

    near = others.select(F.col(key).alias("other"), F.col(lat).alias("_a2"), F.col(lon).alias("_o2"))
    own = rows.select(F.col(key), F.col(lat).alias("_a"), F.col(lon).alias("_o"))
    # rows of one place share the k + 1 nearest, of which a row leaves itself out
    places = own.select("_a", "_o").distinct().withColumn("_at", F.struct("_a", "_o"))
    both = _candidates(places, near, "_at", k)
    km = both.select("_at", "other", S.haversine_km(F.col("_a"), F.col("_o"), F.col("_a2"), F.col("_o2")).alias("km"))
    w = W.partitionBy("_at").orderBy(F.round("km", 6), "other")
    first = km.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k + 1)
    lists = first.groupBy("_at").agg(F.array_sort(F.collect_list(F.struct("place", "other", "km"))).alias("_near")).select("_at._a", "_at._o", "_near")
    met = own.join(lists, ["_a", "_o"]).select(key, F.posexplode(F.slice(F.filter("_near", lambda n: n.other != F.col(key)), 1, k)).alias("place", "_n"))
    return met.select(key, F.col("_n.other").alias("other"), F.col("_n.km").alias("km"), (F.col("place") + 1).alias("place"))


def _cell(level, side: str) -> list[Column]:
    """Cell of a point on each axis at a level; at the next, its halves."""
    return [F.floor((F.col(f"_{c}") + 1) * F.pow(F.lit(2.0), F.lit(level) - 1)).cast("long").alias(f"{side}{c}") for c in AXES]


def _reach(state: DataFrame, k: int) -> DataFrame:
    """Pairs of cells (a: of rows, b: of others) that may hold a nearest pair. The
    farthest corners of the closest cells b with k + 1 others between them bound
    how far the k nearest of any row of a are; a cell that begins beyond goes."""
    from pyspark.sql.window import Window as W

    edge = {side: F.pow(F.lit(2.0), 1 - F.col(f"{side}l")) for side in "ab"}
    low, high = [F.lit(0.0)], [F.lit(0.0)]
    for c in AXES:
        a, b = F.col(f"a{c}") * edge["a"], F.col(f"b{c}") * edge["b"]
        low.append(F.pow(F.greatest(F.lit(0.0), b - a - edge["a"], a - b - edge["b"]), 2))
        high.append(F.pow(F.greatest(b + edge["b"] - a, a + edge["a"] - b), 2))
    cell = W.partitionBy("al", "ax", "ay", "az")
    upto = cell.orderBy("_high", "bl", "bx", "by", "bz").rowsBetween(W.unboundedPreceding, W.currentRow)
    told = state.withColumns({"_low": F.sqrt(sum(low[1:], low[0])), "_high": F.sqrt(sum(high[1:], high[0]))})
    told = told.withColumn("_held", F.sum("n").over(upto))
    bound = F.min(F.when(F.col("_held") > k, F.col("_high"))).over(cell)
    # equal distances are told apart to the millimetre, 1.6e-10 of the radius
    kept = told.withColumn("_bound", bound).filter(F.col("_bound").isNull() | (F.col("_low") <= F.col("_bound") + 1e-8))
    return kept.drop("_low", "_high", "_held", "_bound")


def _candidates(own: DataFrame, near: DataFrame, key: str, k: int) -> DataFrame:
    """Each row with others among which its k nearest are.

    Cells of rows and cells of others are paired from the whole sphere down: while
    a cell of others holds more than FEW, both sides are halved on each axis and
    pairs out of reach go. So a row beside a dense place meets only the parts of
    it that may be nearest, dense places are met in small cells, and what the
    rounds pass on are cells with counts, not rows. Each round is written, so a
    lost executor repeats one round at most."""
    from pyspark.sql.window import Window as W

    point = lambda df, a, o: df.withColumns(dict(zip(("_x", "_y", "_z"), S.unit_sphere(a, o)))).filter("_x IS NOT NULL AND _y IS NOT NULL AND _z IS NOT NULL")
    # of one place the k + 1 smallest keys can be among the nearest
    near = near.withColumn("_n", F.row_number().over(W.partitionBy("_a2", "_o2").orderBy("other"))).filter(F.col("_n") <= k + 1).drop("_n")
    own, near = stored(point(own, "_a", "_o"), "rows")[0], stored(point(near, "_a2", "_o2"), "others")[0]
    a_cells = lambda l: own.select(F.lit(l).alias("al"), *_cell(l, "a")).distinct()  # noqa: E731, E741
    b_cells = lambda l: near.select(F.lit(l).alias("bl"), *_cell(l, "b")).groupBy("bl", "bx", "by", "bz").agg(F.count("*").alias("n"))  # noqa: E731, E741
    state, done = a_cells(0).join(b_cells(0), F.col("al") == F.col("bl")), []
    for level in range(LEVELS + 1):
        dense = (F.col("n") > FEW) if level < LEVELS else F.lit(False)
        state = stored(_reach(state, k).withColumn("open", dense).withColumn("live", F.max("open").over(W.partitionBy("ax", "ay", "az"))), "cells")[0]
        done.append(state.filter("NOT live").select("al", "ax", "ay", "az", "bl", "bx", "by", "bz"))
        live = state.filter("live").drop("live")
        if live.isEmpty():
            break
        up = lambda side: [F.shiftright(f"{side}{c}", 1).alias(f"_{c}") for c in AXES]
        halves = a_cells(level + 1).select("*", *up("a"))
        live = live.drop("al").withColumnsRenamed({f"a{c}": f"_{c}" for c in AXES}).join(halves, ["_x", "_y", "_z"]).drop("_x", "_y", "_z")
        parts = b_cells(level + 1).select("*", *up("b"))
        split = live.filter("open").drop("bl", "n").withColumnsRenamed({f"b{c}": f"_{c}" for c in AXES}).join(parts, ["_x", "_y", "_z"]).drop("_x", "_y", "_z")
        state = split.unionByName(live.filter("NOT open")).drop("open")
    pairs = stored(reduce(DataFrame.unionByName, done), "pairs")[0]
    used = {side: sorted(r[0] for r in pairs.select(f"{side}l").distinct().collect()) for side in "ab"}  # LEVELS + 1 at most
    cells = {side: [f"{side}l", *(f"{side}{c}" for c in AXES)] for side in "ab"}

    def at_levels(df: DataFrame, side: str) -> DataFrame:
        each = F.explode(F.array(*[F.struct(F.lit(x).alias(f"{side}l"), *_cell(x, side)) for x in used[side]]))
        return df.withColumn("_c", each).select(*df.columns, "_c.*") if used[side] else df.select("*", *[F.lit(0).cast("long").alias(c) for c in cells[side]]).limit(0)

    met = at_levels(own.select(key, "_a", "_o", "_x", "_y", "_z"), "a").join(pairs, cells["a"]).select(key, "_a", "_o", *cells["b"])
    met = spread(met)  # few bytes, of which each becomes many pairs: sized by bytes they would stay in one task
    return met.join(at_levels(near, "b").select("other", "_a2", "_o2", *cells["b"]), cells["b"])


def spatial_lag_target(df: DataFrame, lat: str, lon: str, key: str, y: str, k: int, fold: str | None = None) -> DataFrame:
    """Mean target of the k nearest other rows; with `fold`, of other folds."""
    if fold is None:
        n = neighbours(df, df, lat, lon, key, k)
    else:
        n = None
        for f in sorted(r[0] for r in df.select(fold).distinct().collect()):
            part = neighbours(df.filter(F.col(fold) == f), df.filter(F.col(fold) != f), lat, lon, key, k)
            n = part if n is None else n.unionByName(part)
    lag = n.join(df.select(F.col(key).alias("other"), F.col(y).alias("_y")), "other").groupBy(key).agg(F.avg("_y").alias("spatial_lag"))
    return df.join(lag, key, "left")


def neighbour_distance(df: DataFrame, lat: str, lon: str, key: str, k: int) -> DataFrame:
    """Mean distance to the k nearest other rows."""
    return df.join(neighbours(df, df, lat, lon, key, k).groupBy(key).agg(F.avg("km").alias("neighbour_km")), key, "left")


def median_fill_matrix(train: DataFrame, test: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Training medians, all-null columns 0: for models that reject nulls."""
    a, b = impute(train, test, columns)
    return a.fillna(0.0, subset=columns), b.fillna(0.0, subset=columns)
