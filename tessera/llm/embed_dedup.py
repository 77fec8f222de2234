"""Near-duplicate embeddings by collision-counting projections."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from tessera.llm.common import stored
from tessera.llm.components import UnionFind, connected_components


def usable(vector) -> "F.Column":
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def directions(dim: int, n: int, seed: int) -> np.ndarray:
    """n seeded unit directions, one a column."""
    d = np.random.default_rng(seed).standard_normal((dim, n))
    return d / np.linalg.norm(d, axis=0)


def window(dim: int, threshold: float, sigmas: float) -> float:
    """Half width of a query-centred window: unit vectors of cosine `threshold`
    are sqrt(2 - 2t) apart, and that falls on a random direction with standard
    deviation sqrt((2 - 2t) / dim)."""
    return sigmas * math.sqrt(max(2 - 2 * threshold, 0) / dim)


def least_collisions(n: int, sigmas: float, miss: float) -> int:
    """Largest count that a pair at the threshold reaches in n windows but for
    a chance of at most `miss`."""
    p, below = math.erf(sigmas / math.sqrt(2)), 0.0
    for c in range(n + 1):
        below += math.comb(n, c) * p**c * (1 - p) ** (n - c)
        if below > miss:
            return c
    return n


def count_block(a: dict, b: dict, half: float, need: int, threshold: float, same: bool):
    """Positions (i, j) of linked pairs of two blocks. Each projection of block b
    is sorted; the window centred on a vector of block a is the run between two
    binary searches. A pair's collisions are counted over all projections, and
    pairs that reach `need` are verified."""
    pa_, pb, i_all, j_all = a["p"], b["p"], [], []
    order = np.argsort(pb, axis=0, kind="stable")
    along = np.take_along_axis(pb, order, axis=0)
    places = np.argsort(order, axis=0, kind="stable")  # of each vector in each sorted projection
    for at in range(0, len(pa_), 256):  # bounded memory: 256 rows against one block
        n = min(256, len(pa_) - at)
        hits, row = np.zeros((n, len(pb)), "uint8"), np.arange(n)
        for k in range(pa_.shape[1]):
            ends = np.zeros((n, len(pb) + 1), "int8")
            centre = pa_[at : at + n, k]
            np.add.at(ends, (row, np.searchsorted(along[:, k], centre - half, "left")), 1)
            np.add.at(ends, (row, np.searchsorted(along[:, k], centre + half, "right")), -1)
            within = np.cumsum(ends, axis=1, dtype="int8")
            hits += np.take(within, places[:, k], axis=1).view("uint8")
        i, j = np.nonzero(hits >= need)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for s in range(0, len(i), 65_536):
            x, y = i[s : s + 65_536], j[s : s + 65_536]
            dot = np.einsum("nd,nd->n", a["v"][x], b["v"][y])
            ok = dot / (a["n"][x] * b["n"][y]) >= threshold
            i_all.append(x[ok])
            j_all.append(y[ok])
    none = np.empty(0, "int64")
    return (np.concatenate(i_all), np.concatenate(j_all)) if i_all else (none, none)


#: Slices of the range -1..1 of the first projection.
SLICES = 512


def _projected(classes: DataFrame, dim: int, seed: int) -> DataFrame:
    """Add `slice`, the place of each unit vector along the first projection."""

    def run(batches):
        d = directions(dim, 1, seed)
        for b in batches:
            v = np.array(b["v"].flatten().to_numpy(), "float64").reshape(-1, dim)
            at = (v @ d)[:, 0] / np.linalg.norm(v, axis=1)
            place = np.clip(((at + 1) * SLICES / 2).astype("int32"), 0, SLICES - 1)
            yield b.append_column("slice", pa.array(place))

    return classes.mapInArrow(run, "label int, v array<double>, rep long, h long, copies long, slice int")


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """label, slice, parts, block: which block a slice goes to. Slices of more
    than `block` rows are dealt into `parts` blocks by hash."""
    n = rows.groupBy("label", "slice").agg(F.count("*").alias("n"))
    n = n.withColumn("parts", F.ceil(F.col("n") / block).cast("long"))
    by = W.partitionBy("label").orderBy("slice")
    room = F.sum("n").over(by) - F.col("n")
    n = n.withColumn("bin", F.floor(room / block)).withColumn("wide", F.col("parts") > 1)
    first = F.when(F.lag("bin").over(by).isNull() | (F.lag("bin").over(by) != F.col("bin")) | F.col("wide") | F.coalesce(F.lag("wide").over(by), F.lit(False)), F.lag("parts", 1, 1).over(by)).otherwise(0)
    return n.withColumn("block", F.sum(first).over(by.rowsBetween(W.unboundedPreceding, 0))).select("label", "slice", "parts", "block")


def _links(classes: DataFrame, dim: int, threshold: float, projections: int, sigmas: float, miss: float, block: int, seed: int) -> DataFrame:
    """rep, h, links (copies of linked other vectors) and root (a linked rep)."""
    rows = stored(_projected(classes, dim, seed), "projected")
    place = stored(_blocks(rows, block), "blocks")
    reach = math.ceil(window(dim, threshold, 5.0) * SLICES / 2) + 1
    one = place.select("label", "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "block")
    spans = one.groupBy("label", (F.col("block") + F.col("part")).alias("b")).agg(F.min("slice").alias("lo"), F.max("slice").alias("hi"))
    other = spans.select("label", F.col("b").alias("c"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    pairs = spans.join(other, "label").filter(f"b <= c AND lo2 - hi <= {reach} AND lo - hi2 <= {reach}")
    sides = pairs.select("label", "b", "c", F.explode(F.array_distinct(F.array("b", "c"))).alias("block"))
    homed = rows.join(place, ["label", "slice"]).withColumn("block", F.col("block") + F.pmod("h", "parts"))
    dealt = homed.join(sides, ["label", "block"]).select("label", "b", "c", "block", "rep", "h", "copies", "v")
    half, need = window(dim, threshold, sigmas), least_collisions(projections, sigmas, miss)

    def run(key, table):
        d = directions(dim, projections, seed + 1)
        b, c = key[1].as_py(), key[2].as_py()
        side, sets = table["block"].to_numpy(), []
        for x in (b, c):
            part = table.filter(pa.array(side == x))
            v = np.array(part["v"].combine_chunks().flatten().to_numpy(), "float64").reshape(-1, dim)
            n = np.sqrt(np.einsum("nd,nd->n", v, v))
            sets.append({"v": v, "n": n, "p": ((v @ d) / n[:, None]).astype("float32"), "rep": part["rep"].to_numpy(), "h": part["h"].to_numpy(), "copies": part["copies"].to_numpy()})
            if b == c:
                sets.append(sets[0])
                break
        x, y = sets
        i, j = count_block(x, y, half, need, threshold, b == c)
        m, n = len(x["n"]), 0 if b == c else len(y["n"])
        other = j if b == c else j + m
        all_ = {k: x[k] if b == c else np.concatenate([x[k], y[k]]) for k in ("rep", "h", "copies")}
        links = np.bincount(i, all_["copies"][other], m + n) + np.bincount(other, all_["copies"][i], m + n)
        order = np.argsort(all_["rep"], kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(m + n)
        sets_ = UnionFind(m + n)
        for a, e in zip(rank[i].tolist(), rank[other].tolist()):
            sets_.union(a, e)
        hit = np.nonzero(links)[0]
        root = [all_["rep"][order[sets_.find(r)]] for r in rank[hit].tolist()]
        return pa.table({"rep": pa.array(all_["rep"][hit]), "h": pa.array(all_["h"][hit]), "links": pa.array(links[hit].astype("int64")), "root": pa.array(root, pa.int64())})

    return dealt.groupBy("label", "b", "c").applyInArrow(run, "rep long, h long, links long, root long")


def near_vectors(
    vectors: DataFrame, threshold: float = 0.93, projections: int = 24, sigmas: float = 2.0, miss: float = 1e-7, block: int = 4096, seed: int = 5
) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row (vec_id, embedding, label).

    Equal vectors of a label collapse first into one row with its copies. The
    distinct ones are sorted by a first projection within their label and cut
    into blocks of about `block` rows; two blocks meet if their ranges lie
    within the widest window. A task sorts `projections` random directions of a
    block, counts for each pair the query-centred windows in which it collides,
    verifies pairs that reach the recall-calibrated count by
    cosine in double precision, and returns link counts and a spanning forest,
    never the pairs. A pair at the threshold is missed with a chance near 1e-6.

    Rows whose label is null or whose vector is null, empty, zero or holds null
    or non-finite components link with nothing: n_links 0, kept, their own
    component. Vectors of unequal length never link. A null vec_id takes no
    part: n_links 0, component_id null, kept false. Rows that repeat a vec_id
    are vectors of their own, and so are their components, each with its own
    smallest vec_id. Extra columns are ignored."""
    spark = vectors.sparkSession
    base = stored(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("v")), "vectors")
    good = base.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    classes = good.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    # a number of its own for each distinct vector: ids may repeat
    classes = stored(classes.select("label", "v", F.col("rep").alias("id"), F.monotonically_increasing_id().alias("rep"), F.xxhash64("label", "v").alias("h"), "copies"), "classes")
    sizes = [r[0] for r in good.select(F.size("v")).distinct().collect()]
    found = spark.createDataFrame([], "rep long, h long, links long, root long")
    for dim in sorted(sizes):
        found = found.union(_links(classes.filter(F.size("v") == dim).select("label", "v", "rep", "h", "copies"), dim, threshold, projections, sigmas, miss, block, seed))
    found = stored(found, "links")
    links = found.groupBy("rep", "h").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    placed = classes.join(links, ["rep", "h"], "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    placed = placed.withColumn("component", F.coalesce("component", "rep"))
    named = placed.groupBy("component").agg(F.min("id").alias("c"))
    done = placed.join(named, "component").select("label", "v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "c")
    return base.join(done, (base["label"] == done["label"]) & (base["v"] == done["v"]) & base["vec_id"].isNotNull(), "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("c", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("c", "vec_id"), F.lit(False)).alias("kept"),
    )
