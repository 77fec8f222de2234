"""Correlations of all pairs of columns from two scans, whatever their number."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.sources.shared import stored

#: Columns a block has, rows that are turned into a matrix at once, and bytes of
#: sums that a task holds at most: more pairs of blocks take another scan.
WIDTH, ROWS, SUM_BYTES = 128, 4096, 1 << 28


def pair_sums(x: np.ndarray, i: slice, j: slice) -> np.ndarray:
    """6 x columns of i x columns of j: over rows with both values their number,
    sums of either, of both squares and of the product."""
    m = ~np.isnan(x)
    v = np.where(m, x, 0.0)
    a, b, ma, mb = v[:, i], v[:, j], m[:, i].astype("float64"), m[:, j].astype("float64")
    return np.stack([ma.T @ mb, a.T @ mb, ma.T @ b, (a * a).T @ mb, ma.T @ (b * b), a.T @ b])


def correlations(sums: np.ndarray) -> np.ndarray:
    """Pearson of each pair; NaN without spread. A spread that is rounding left
    over from the sums is none."""
    n, sa, sb, qa, qb, p = sums
    with np.errstate(divide="ignore", invalid="ignore"):
        va, vb = qa / n - (sa / n) ** 2, qb / n - (sb / n) ** 2
        r = (p / n - sa / n * sb / n) / np.sqrt(va * vb)
        flat = (va <= 1e-12 * qa / n) | (vb <= 1e-12 * qb / n)
    return np.where(flat | (n < 1), np.nan, np.clip(r, -1, 1))


def pair_correlations(df: DataFrame, columns: list[str], threshold: float | None = None) -> DataFrame:
    """a, b and r of each pair in the order of `columns`, over rows that have both
    values; r is null without spread. With a threshold: pairs of larger abs r only.

    One scan takes each column's mean, so that sums of squares lose no digits;
    one adds up, for pairs of blocks of columns, six matrices in each task, which
    Spark sums by block pair and turns into correlations there. Infinite values
    count as missing."""
    schema, spark = "a string, b string, r double", df.sparkSession
    if len(columns) < 2:
        return spark.createDataFrame([], schema)
    finite = lambda c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double"))
    rows = df.select(*[finite(c).alias(f"c{k}") for k, c in enumerate(columns)])
    means = rows.agg(F.array(*[F.avg(c) for c in rows.columns]).alias("m")).first()["m"]
    shift = spark.sparkContext.broadcast(np.array([m or 0.0 for m in means]))
    blocks = [slice(k, min(k + WIDTH, len(columns))) for k in range(0, len(columns), WIDTH)]
    pairs = [(i, j) for i in range(len(blocks)) for j in range(i, len(blocks))]
    most = max(1, SUM_BYTES // (48 * WIDTH * WIDTH))

    def scanned(own: list[tuple[int, int]]) -> DataFrame:
        def run(batches):
            sums = {}
            for b in batches:
                for at in range(0, b.num_rows, ROWS):
                    part = b.slice(at, ROWS)
                    x = np.stack([c.to_numpy(zero_copy_only=False).astype("float64") for c in part.columns], 1) - shift.value
                    for i, j in own:
                        sums[i, j] = sums.get((i, j), 0) + pair_sums(x, blocks[i], blocks[j])
            for (i, j), s in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([s.tobytes()], pa.binary())], ["i", "j", "sums"])

        def add(table):
            i, j = table["i"][0].as_py(), table["j"][0].as_py()
            shape = 6, blocks[i].stop - blocks[i].start, blocks[j].stop - blocks[j].start
            total = sum(np.frombuffer(s.as_py(), "float64") for s in table["sums"]).reshape(shape)
            r = correlations(total)
            upper = np.arange(blocks[i].start, blocks[i].stop)[:, None] < np.arange(blocks[j].start, blocks[j].stop)[None, :]
            x, y = np.nonzero(upper if threshold is None else upper & (np.abs(np.nan_to_num(r)) > threshold))
            name = lambda at, block: pa.array([columns[k + block.start] for k in at.tolist()], pa.string())
            return pa.table([name(x, blocks[i]), name(y, blocks[j]), pa.array(r[x, y], mask=np.isnan(r[x, y]))], ["a", "b", "r"])

        return rows.mapInArrow(run, "i int, j int, sums binary").groupBy("i", "j").applyInArrow(add, schema)

    out = scanned(pairs[:most])
    for at in range(most, len(pairs), most):
        out = out.unionByName(scanned(pairs[at : at + most]))
    return stored(out, "correlations")[0]
