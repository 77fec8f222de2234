"""Approximate nearest neighbours over shifted Hilbert curves."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from tessera.llm.common import stored
from tessera.llm.embed_dedup import usable

BITS, AXES = 10, 6


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along a Hilbert curve of each row of integer coordinates, by
    Skilling's transpose method: undo excess rotations from the top bit down,
    Gray-decode, then interleave the bits."""
    x = cells.astype("int64").T.copy()
    axes = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for k in range(axes):
            high = (x[k] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[k] ^= swap
        q >>= 1
    for k in range(1, axes):
        x[k] ^= x[k - 1]
    flip, q = np.zeros(x.shape[1], "int64"), 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], "int64")
    for bit in range(bits - 1, -1, -1):
        for k in range(axes):
            key = (key << 1) | ((x[k] >> bit) & 1)
    return key


class Curves:
    """Projections, shifts and scales of several Hilbert orderings.

    Fitted on a bounded sample: its principal directions, turned at random for
    each curve. Inner product becomes nearness by one more coordinate that
    lifts every candidate to the length of the longest (`top`)."""

    def __init__(self, sample: np.ndarray, top: float, curves: int, seed: int):
        rng, self.top = np.random.default_rng(seed), top
        lifted = self.lift(sample, False)
        self.mean = lifted.mean(axis=0)
        w, v = np.linalg.eigh(np.cov((lifted - self.mean).T) if len(lifted) > 1 else np.eye(lifted.shape[1]))
        keep = min(2 * AXES, len(w))
        self.turns, self.shifts = [], []
        for _ in range(curves):
            turn = np.linalg.qr(rng.standard_normal((keep, keep)))[0][:, :AXES]
            turn = v[:, ::-1][:, :keep] @ np.pad(turn, ((0, 0), (0, AXES - turn.shape[1])))
            self.turns.append(turn)
            self.shifts.append(rng.uniform(0, 1, AXES))
        spread = max(float(np.sqrt(max(w[-1], 1e-12))), 1e-9)
        self.scale = (1 << BITS) / (12 * spread)

    def lift(self, v: np.ndarray, query: bool) -> np.ndarray:
        norm2 = np.einsum("nd,nd->n", v, v)
        if query:
            return np.hstack([v / np.sqrt(norm2)[:, None] * self.top, np.zeros((len(v), 1))])
        return np.hstack([v, np.sqrt(np.maximum(self.top**2 - norm2, 0))[:, None]])

    def keys(self, v: np.ndarray, query: bool):
        at = self.lift(v, query) - self.mean
        for turn, shift in zip(self.turns, self.shifts):
            cell = (at @ turn) * self.scale + (1 << BITS) * (0.5 + 0.25 * (shift - 0.5))
            yield hilbert_keys(np.clip(cell, 0, (1 << BITS) - 1).astype("int64"))


def matrix(column, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.array(column.flatten().to_numpy(zero_copy_only=False), "float64").reshape(-1, dim)


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    """Of each query its k best rows: (ids, scores), largest inner product first,
    ties to smaller ids, the query's own row left out. A matrix product finds
    the rows near the top; their scores are then summed pair by pair, so a pair
    scores alike wherever it is met."""
    order = np.argsort(row_ids, kind="stable")
    rows, row_ids = rows[order], row_ids[order]
    for at in range(0, len(queries), 256):
        got = queries[at : at + 256] @ rows.T
        got[query_ids[at : at + 256, None] == row_ids[None, :]] = -np.inf
        for q, s in enumerate(got):
            # all rows within rounding of the k-th
            if len(s) > k:
                kth = np.partition(s, len(s) - k)[len(s) - k]
                idx = np.nonzero((s >= kth - 1e-9 * max(1.0, abs(kth))) & (s > -np.inf))[0] if kth > -np.inf else np.nonzero(s > -np.inf)[0]
            else:
                idx = np.nonzero(s > -np.inf)[0]
            exact = (rows[idx] * queries[at + q]).sum(axis=1)
            top = np.lexsort((row_ids[idx], -exact))[:k]
            yield row_ids[idx][top], exact[top]


def _merge(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """Best k of the lists in column `hits` (structs of -score and vec_id). A
    pair scores alike in each list, so repeats lie side by side once sorted."""
    every = found.groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("a"))
    once = F.filter("a", lambda x, i: (i == 0) | (x.vec_id != F.get("a", i - 1).vec_id))
    return every.select(*keys, F.slice(once, 1, k).alias("hits"))


HITS = "array<struct<neg:double,vec_id:long>>"


def _hits(found) -> pa.Array:
    kind = pa.list_(pa.struct([("neg", pa.float64()), ("vec_id", pa.int64())]))
    return pa.array([[{"neg": -s, "vec_id": i} for i, s in zip(ids.tolist(), sc.tolist())] for ids, sc in found], kind)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, curves: int = 4, recall: float = 0.97, sample: int = 4096, calibrate: int = 64, block: int = 2048, seed: int = 11
) -> DataFrame:
    """query_id, rank, vec_id and score of the k rows of `vectors` found nearest
    to each row of `queries` by inner product (both: vec_id, embedding).

    Every vector and query gets a key on each of `curves` Hilbert orderings of
    turned, shifted projections; Spark range-partitions and sorts them by key.
    A query is compared in double precision with the rows in the windows around
    its places, and the windows' lists are merged. The window's half width is
    measured, not guessed: for at most `calibrate` queries the true k nearest
    are found over all rows, and the width is the smallest that holds the share
    `recall` of them in at least one ordering. The curves are fitted on at most
    `sample` vectors; all are indexed.

    Vectors that are null, empty, zero, of unequal length to the most common
    one, or hold null or non-finite components take no part, nor do null
    vec_ids. Rows that repeat a vec_id count once, with the first vector by
    content. Fewer than k candidates: all. An empty table gives none."""
    spark = vectors.sparkSession

    def clean(df):
        ok = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
        return ok.groupBy("vec_id").agg(F.min("v").alias("v"))

    base = stored(clean(vectors).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))), "ann-rows")
    shape = base.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.max("norm").alias("top")).orderBy(F.desc("n"), "dim").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if shape is None:
        return spark.createDataFrame([], schema)
    dim, n, top = shape
    base = base.filter(F.size("v") == dim)
    asked = stored(clean(queries).filter(F.size("v") == dim), "ann-queries")
    n_asked = asked.count()
    if not n_asked:
        return spark.createDataFrame([], schema)
    some = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toPandas()
    index = Curves(np.array(some["v"].tolist(), "float64"), top, curves, seed)

    def key_rows(query: bool):
        def run(batches):
            for b in batches:
                for c, keys in enumerate(index.keys(matrix(b["v"], dim), query)):
                    m = b.num_rows
                    yield pa.RecordBatch.from_arrays([pa.array([c] * m, pa.int32()), pa.array(keys), pa.array([query] * m), b["vec_id"], b["v"]], ["curve", "key", "query", "vec_id", "v"])

        return run

    kind = base.schema["v"].dataType.simpleString()
    keyed = "curve int, key long, query boolean, vec_id long, v " + kind
    both = base.select("vec_id", "v").mapInArrow(key_rows(False), keyed).union(asked.mapInArrow(key_rows(True), keyed))
    parts = max(curves, -(-curves * (n + n_asked) // 16_384))
    dealt = both.repartitionByRange(parts, "curve", "key", "query", "vec_id").sortWithinPartitions("curve", "key", "query", "vec_id")

    def number(batches):
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            yield b.append_column("part", pa.array([part] * b.num_rows, pa.int32())).append_column("at", pa.array(np.arange(at, at + b.num_rows)))
            at += b.num_rows

    placed = stored(dealt.mapInArrow(number, keyed + ", part int, at long"), "ann-keys")
    # one row for each curve and range partition: offsets of the partitions
    sizes = placed.groupBy("curve", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    sizes = sizes.withColumn("skip", F.sum("n").over(W.partitionBy("curve").orderBy("part")) - F.col("n") - F.col("first")).select("curve", "part", "skip")
    ranked = placed.join(sizes, ["curve", "part"]).withColumn("place", F.col("at") + F.col("skip")).drop("part", "at", "skip")

    # how far apart true neighbours lie in the nearest ordering
    probe = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(calibrate).toPandas()
    pq, pid = np.array(probe["v"].tolist(), "float64"), probe["vec_id"].to_numpy()

    def true_best(batches):
        for b in batches:
            found = list(best(pq, pid, matrix(b["v"], dim), b["vec_id"].to_numpy(), k))
            yield pa.RecordBatch.from_arrays([pa.array(pid), _hits(found)], ["query_id", "hits"])

    truth = _merge(base.mapInArrow(true_best, "query_id long, hits " + HITS), k, "query_id").select("query_id", F.explode("hits.vec_id").alias("vec_id"))
    spots = ranked.select("curve", "query", "vec_id", "place")
    q_spots = spots.filter("query").select("curve", F.col("vec_id").alias("query_id"), F.col("place").alias("from"))
    gaps = truth.join(q_spots, "query_id").join(spots.filter("NOT query"), ["curve", "vec_id"]).groupBy("query_id", "vec_id").agg(F.min(F.abs(F.col("place") - F.col("from"))).alias("gap"))
    gaps = [r[0] for r in gaps.select("gap").collect()]  # at most calibrate * k
    half = int(np.quantile(gaps, recall)) + 1 if gaps else block

    chunks = max(1, -(-n_asked // 8192))
    rows = ranked.filter("NOT query").select("curve", F.floor(F.col("place") / block).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "query", "vec_id", "v")
    low, high = F.greatest(F.lit(0), F.floor((F.col("place") - half) / block)), F.floor((F.col("place") + half) / block)
    ask = ranked.filter("query").select("curve", F.explode(F.sequence(low.cast("long"), high)).alias("block"), F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"), "query", "vec_id", "v")

    def compare(key, t):
        asking = t["query"].to_numpy(zero_copy_only=False)
        left, right = t.filter(pa.array(asking)), t.filter(pa.array(~asking))
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "hits": _hits([])})
        ids = left["vec_id"].to_numpy()
        found = list(best(matrix(left["v"], dim), ids, matrix(right["v"], dim), right["vec_id"].to_numpy(), k))
        return pa.table({"query_id": pa.array(ids), "hits": _hits(found)})

    found = ask.unionByName(rows).groupBy("curve", "block", "chunk").applyInArrow(compare, "query_id long, hits " + HITS)
    merged = _merge(found, k, "query_id")
    return merged.select("query_id", F.posexplode("hits").alias("i", "h")).select("query_id", (F.col("i") + 1).alias("rank"), F.col("h.vec_id").alias("vec_id"), (-F.col("h.neg")).alias("score"))
