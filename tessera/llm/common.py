"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: `spark.checkpoint.dir`. A session
    on one machine that has none gets a temporary one; on a cluster that is an
    error, since each machine would have its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        found = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are computed once and outlive any executor."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def give_back() -> None:
    """Return what a Python worker has freed to the machine: it goes on to other
    tasks, and idle ones stay beside those at work."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def slices(batches, rows: int = 512, most: int = 1 << 22):
    """Arrow batches in slices of at most `rows` rows and, unless one row alone
    has more, `most` bytes of text: what a task holds in Python objects at once
    stays small however long the texts of a batch are."""
    for b in batches:
        upto = np.zeros(b.num_rows + 1, "int64")
        for c in b.columns:
            if pa.types.is_string(c.type) or pa.types.is_large_string(c.type):
                upto[1:] += np.cumsum(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype("int64"))
        at = 0
        while at < b.num_rows:
            fits = int(np.searchsorted(upto, upto[at] + most, "right")) - 1
            end = min(at + rows, max(at + 1, fits), b.num_rows)
            yield b.slice(at, end - at)
            at = end


def small_slices(batches, rows: int = 512, most: int = 1 << 22):
    """`slices`, for tasks of whom many follow each other in one worker: what
    they free is given back before, between and behind the batches."""
    give_back()
    for b in batches:
        yield from slices([b], rows, most)
        del b
        pa.default_memory_pool().release_unused()
    give_back()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet below the shared folder and read it back; unlike
    `cut` the copy is columnar, so later stages read only what they use."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Members:
    """Bloom filter of a column of 64-bit hashes, built in Spark, of MOST_BITS at
    most whatever their number: with more hashes it lets more others through,
    which a join behind it takes out."""

    MOST_BITS, PROBES = 1 << 28, 4

    def __init__(self, hashes: DataFrame, column: str):
        h = F.col(column)
        self.bits = 1 << min(self.MOST_BITS.bit_length() - 1, max(10, (16 * hashes.count()).bit_length()))
        low, step = h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
        at = F.explode(F.array(*[(low + step * k).bitwiseAND(self.bits - 1) for k in range(self.PROBES)]))
        one = F.expr("bit_or(shiftleft(1L, CAST(at & 63 AS INT)))")
        words = hashes.filter(h.isNotNull()).select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(one.alias("bit")).toArrow()
        flat = np.zeros(self.bits >> 6, "int64")
        flat[words["word"].to_numpy()] = words["bit"].to_numpy()
        self.spark, self.shared = hashes.sparkSession, hashes.sparkSession.sparkContext.broadcast(flat)

    def __getstate__(self):
        return {"bits": self.bits, "shared": self.shared}

    def maybe(self, h: np.ndarray) -> np.ndarray:
        """False: surely not in the column."""
        flat, found = self.shared.value, np.ones(len(h), "bool")
        low, step = h & 0xFFFFFFFF, (h >> 32 & 0xFFFFFFFF) | 1
        for k in range(self.PROBES):
            at = (low + step * k) & (self.bits - 1)
            found &= (flat[at >> 6] >> (at & 63)) & 1 == 1
        return found

    def column(self, name: str) -> Column:
        @F.pandas_udf("boolean")
        def maybe(h):
            import pandas as pd

            return pd.Series(self.maybe(h.to_numpy()))

        return maybe(F.col(name))
