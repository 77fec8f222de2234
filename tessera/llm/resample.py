"""Importance resampling towards a target distribution, ranked by a distributed radix sort."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tessera.llm.common import slices, stored

#: Everything but digits, letters A-Z and a-z and what is not ASCII ends a word.
TO_BLANK = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
CACHE = 200_000
#: Bits of a digit at most; rows a chunk of positions has at least, but for one
#: chunk alone, and chunks at most: a chunk is streamed, never held whole.
DIGIT_BITS, CHUNK_ROWS, MOST_CHUNKS = 12, 1 << 14, 4096
FIELDS = ["doc_id", "n_features", "weight", "score"]


class Buckets(dict):
    """feature (bytes) -> bucket; holds the CACHE last met."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[feature] = found = zlib.crc32(feature) % self.buckets
        return found

    def of(self, raw: bytes, most: int) -> tuple[int, np.ndarray]:
        """Number of words of a text, and the bucket of each of its features."""
        words = raw.translate(TO_BLANK).split()
        found = list(map(self.__getitem__, words)) if most else []
        for n in range(2, most + 1):
            found += [self[b" ".join(words[i : i + n])] for i in range(len(words) - n + 1)]
        return len(words), np.array(found, "int64")


def bucket_counts(texts: DataFrame, buckets: int, most: int) -> np.ndarray:
    """Features in each bucket over all texts: an array of fixed size, summed by
    Spark from one a task."""

    def run(batches):
        known, total = Buckets(buckets), np.zeros(buckets, "int64")
        for b in slices(batches, 2048):
            for raw in b["text"].cast(pa.binary()).to_pylist():
                total += np.bincount(known.of(raw or b"", most)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    found = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, "int64")
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of both smoothed shares, rounded down."""
    b, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + b) / ((s + 1) * (t_all + b)))) for s, t in zip(source.tolist(), target.tolist())], "int64")


def noise(doc_id, seed: int) -> int:
    """Thousandths of a Gumbel number drawn by seed and doc_id, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray, most: int, seed: int) -> DataFrame:
    """doc_id, n_features, weight, score and n_words of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        gain = shared.value
        known = Buckets(len(gain))
        for b in slices(batches, 2048):
            ids, out = b["doc_id"].to_pylist(), []
            for doc_id, raw in zip(ids, b["text"].cast(pa.binary()).to_pylist()):
                words, found = known.of(raw or b"", most)
                weight = int(gain[found].sum()) // len(found) if len(found) else 0
                out.append((len(found), weight, weight + noise(doc_id, seed), words))
            cols = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([b["doc_id"], *[pa.array(c, pa.int64()) for c in cols]], [*FIELDS, "n_words"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_features long, weight long, score long, n_words long")


# ---- radix sort


def key_fields(facts) -> list[tuple]:
    """(column expression, bits) of the parts of the sort key, least first: score
    falling, then doc_id (null last), then n_features; each as its distance from
    the smallest, in as many bits as the largest needs. doc_id comes as two
    halves, so that no distance overflows."""
    high, low = F.shiftright("doc_id", 32), F.col("doc_id").bitwiseAND(0xFFFFFFFF)
    one_high = facts["high0"] == facts["high1"]
    low0, low1 = (facts["low0"], facts["low1"]) if one_high else (0, 0xFFFFFFFF)
    zero = lambda c: F.coalesce(c, F.lit(0))
    return [
        (F.col("n_features") - facts["features0"], (facts["features1"] - facts["features0"]).bit_length()),
        *([(zero(low - low0), (low1 - low0).bit_length()), (zero(high - facts["high0"]), (facts["high1"] - facts["high0"]).bit_length())] if facts["high0"] is not None else []),
        (F.col("doc_id").isNull().cast("long"), int(facts["nulls"] > 0)),
        (facts["score1"] - F.col("score"), (facts["score1"] - facts["score0"]).bit_length()),
    ]


def digit(fields: list[tuple], at: int, width: int):
    """Bits at .. at + width - 1 of all parts of the key, seen as one number."""
    out, base = F.lit(0).cast("long"), 0
    for value, bits in fields:
        low, high = max(at, base), min(at + width, base + bits)
        if low < high:
            own = F.shiftrightunsigned(value.cast("long"), low - base).bitwiseAND((1 << high - low) - 1)
            out = out.bitwiseOR(F.shiftleft(own, low - at))
        base += bits
    return out


def counting_sort(rows: DataFrame, key, chunks: int, size: int | None) -> DataFrame:
    """One stable pass: rows get the position (pos) that counting by digit gives.

    Chunks are runs of positions, of `size` positions or, on the first pass, the
    rows of a file split. Digits are counted by chunk; prefix sums over digits,
    then chunks, give where each chunk's rows of a digit begin; a chunk's task
    then reads its rows in order and hands out places as it goes."""
    chunk = F.floor(F.col("pos") / size).cast("long") if size else F.shiftright("pos", 33)
    rows = rows.select(*FIELDS, "pos", chunk.alias("chunk"), key.alias("digit"))
    counts = rows.groupBy("digit", "chunk").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("digit").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    counts = stored(counts.select("digit", "chunk", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier")), "radix-counts")
    total = counts.groupBy("digit").agg(F.sum("n").alias("n")).toArrow()  # one a digit
    each = np.zeros(1 << DIGIT_BITS, "int64")
    each[total["digit"].to_numpy()] = total["n"].to_numpy()
    base = np.cumsum(each) - each
    shared = rows.sparkSession.sparkContext.broadcast(base)
    starts = counts.groupBy("chunk").agg(F.collect_list("digit").alias("digits"), F.collect_list("earlier").alias("starts"))

    def run(batches):
        at = None
        for b in batches:
            digits, firsts, lists = b["digit"].to_numpy(zero_copy_only=False), b["digits"], b["starts"]
            heads = np.flatnonzero(np.asarray(firsts.is_valid()))
            for lo, hi in zip([0, *heads], [*heads, b.num_rows]):
                if lo < hi and firsts[int(lo)].is_valid:  # a chunk begins
                    at, own = shared.value.copy(), np.array(firsts[int(lo)].as_py())
                    at[own] += np.array(lists[int(lo)].as_py())
                    lo += 1
                if lo >= hi:
                    continue
                d = digits[lo:hi].astype("int64")
                order = np.argsort(d, kind="stable")
                kinds, begin, n = np.unique(d[order], return_index=True, return_counts=True)
                place = np.empty(len(d), "int64")
                place[order] = np.repeat(at[kinds] - begin, n) + np.arange(len(d))
                at[kinds] += n
                yield pa.RecordBatch.from_arrays([*[b[c].slice(lo, hi - lo) for c in FIELDS], pa.array(place)], [*FIELDS, "pos"])

    null = lambda c, kind: F.lit(None).cast(kind).alias(c)
    heads = starts.select(*[null(c, "long") for c in FIELDS], F.lit(-1).cast("long").alias("pos"), "chunk", null("digit", "long"), "digits", "starts")
    every = rows.select("*", null("digits", "array<long>"), null("starts", "array<long>")).unionByName(heads)
    dealt = every.repartition(chunks, "chunk").sortWithinPartitions("chunk", "pos")
    return dealt.mapInArrow(run, "doc_id long, n_features long, weight long, score long, pos long")


def ranked(rows: DataFrame) -> DataFrame:
    """FIELDS of `rows` and pos: 0, 1, 2.. by score, highest first, ties by
    smaller doc_id (null last), then by fewer features. `rows` is a stored table
    with any distinct numbers pos, as monotonically_increasing_id gives them."""
    high, low = F.shiftright("doc_id", 32), F.col("doc_id").bitwiseAND(0xFFFFFFFF)
    ends = {"features": F.col("n_features"), "score": F.col("score"), "high": high, "low": low}
    facts = rows.agg(F.count("*").alias("n"), F.sum(F.col("doc_id").isNull().cast("long")).alias("nulls"), F.max("pos").alias("last"), *[f(c).alias(n + k) for n, c in ends.items() for f, k in ((F.min, "0"), (F.max, "1"))]).first()
    n = facts["n"]
    if not n:
        return rows.select(*FIELDS, "pos")
    fields = key_fields(facts)
    bits = sum(b for _, b in fields)
    passes = max(1, -(-bits // DIGIT_BITS))
    width = max(1, -(-bits // passes))
    chunks, size = (facts["last"] >> 33) + 1, None
    for k in range(passes):
        rows = stored(counting_sort(rows, digit(fields, k * width, width), chunks, size), "radix")
        chunks = min(MOST_CHUNKS, -(-n // CHUNK_ROWS))
        size = -(-n // chunks)
    return rows


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, buckets: int = 10_000, most: int = 1, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of each row.

    Features are runs of 1 to `most` words of the whole text, hashed to
    `buckets`; a bucket's gain is the log ratio of its smoothed shares in
    `target` and `docs` in thousandths, a row's weight the mean gain of its
    features, its score that weight and Gumbel noise drawn by seed and doc_id.
    Of the rows with `least_words` words, `percent` in a hundred are drawn, those
    with the highest scores, ties to the smaller doc_id: a draw without
    replacement by weight.

    Null texts have no words; rows without features weigh 0. A null doc_id draws
    its noise from the empty name and ranks behind equal scores; rows that repeat
    a doc_id are ranked each, those of one score by fewer features. Extra columns
    are ignored; an empty table gives none.

    The counts are arrays of `buckets` numbers, sent to all tasks. Scores are
    sorted by passes of a stable counting sort over the digits of the whole key;
    a pass shuffles six numbers a row and keeps no chunk in memory."""
    s, t = (bucket_counts(x, buckets, most) for x in (docs, target))
    scored = stored(weighted(docs, gains(s, t), most, seed).withColumn("pos", F.monotonically_increasing_id()), "weights")
    able = scored.filter(F.col("n_words") >= least_words)
    order = ranked(able.select(*FIELDS, "pos"))
    drawn = able.count() * percent // 100
    rank = F.when(F.col("pos") < drawn, F.col("pos") + 1).alias("rank")
    rest = scored.filter(F.col("n_words") < least_words).select(*FIELDS, F.lit(None).cast("long").alias("rank"))
    return order.select(*FIELDS, rank).unionByName(rest)
