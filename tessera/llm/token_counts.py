"""Token counts through a digest cache."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import Members, small_slices, stored
from tessera.llm.tokens import encoder

CACHE = "content binary, tokenizer string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file: a changed file never hits old counts."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def read_cache(spark, path: str) -> DataFrame:
    """The cache table, empty if nothing has been written yet."""
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], CACHE)


def encode_misses(rows: DataFrame, misses: Members, tokenizer: str, version: str) -> DataFrame:
    """Cache rows of the texts whose `row` may be in `misses`, encoded where they
    lie; a slice encodes a text once."""

    def run(batches):
        enc = encoder(tokenizer)
        for b in small_slices(batches):
            b = b.filter(pa.array(misses.maybe(b["row"].to_numpy())))
            texts = dict(zip(b["content"].to_pylist(), b["text"].to_pylist()))
            n = [len(ids) // 4 for ids in enc.ids(list(texts.values()))]
            yield pa.RecordBatch.from_arrays([pa.array(list(texts), pa.binary()), pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())], ["content", "tokenizer", "n_tokens"])

    return rows.select("row", "content", "text").mapInArrow(run, CACHE)


def count_tokens(docs: DataFrame, tokenizer: str, cache_path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each row of `docs`.

    The digest of a text's content and that of the tokenizer file are the cache
    key. Content is normalised only as far as counts surely stay the same: null
    becomes the empty text (a tokenizer's own normaliser would not do, since
    special strings are looked for before it runs).

    Digests without a stored count are the misses; one row of each, by smallest
    doc_id, stands for its copies. A filter of fixed size tells the tasks which
    rows those are, so they are encoded where they lie: digests and counts are
    shuffled, texts never. Misses are appended to the cache, which then answers
    all rows; a later call on the same path encodes new texts only. Repeated
    rows each get a result; an empty table gives none."""
    spark, version = docs.sparkSession, tokenizer_version(tokenizer)
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("content", F.unhex(F.sha2("text", 256))).withColumn("row", F.xxhash64("doc_id", "content"))
    rows = stored(base.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content", "row"), "token-rows")
    known = read_cache(spark, cache_path).filter(F.col("tokenizer") == version)
    stands = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).getField("row")
    misses = rows.groupBy("content").agg(stands.alias("row")).join(known.select("content"), "content", "left_anti")
    misses = stored(misses, "token-misses")
    found = encode_misses(base, Members(misses, "row"), tokenizer, version).dropDuplicates(["content"])
    found.join(misses.select("content"), "content", "left_semi").write.mode("append").parquet(cache_path)
    counts = read_cache(spark, cache_path).filter(F.col("tokenizer") == version).select("content", "n_tokens").dropDuplicates(["content"])
    counts = stored(counts.join(rows.select("content").distinct(), "content", "left_semi"), "token-counts")  # a plain scan below the join: a hot digest can then be split
    return rows.join(counts, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
