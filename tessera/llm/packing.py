"""Best-fit packing of tokenised documents into fixed-length sequences."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

from tessera.llm.common import small_slices, stored
from tessera.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """Tokenise each whole text, append `end_id`, cut documents longer than
    `capacity` into pieces of that length. `with_ids` adds column `ids`.

    Null text counts as empty, so every row yields at least one piece."""

    def run(batches):
        enc, end = encoder(tokenizer), int(end_id).to_bytes(4, "little")
        for batch in small_slices(batches):
            out = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), enc.ids(batch["text"].to_pylist())):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part))
            cols = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(p, "<u4").astype("int32") for p in cols[5]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


class Capacities:
    """Segment tree over remaining capacities 0..top: counts open bins per
    capacity; `tightest(need)` finds the smallest capacity >= need that has an
    open bin in logarithmic time."""

    def __init__(self, top: int):
        self.leaves = 1 << (top + 1 - 1).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list] = [[] for _ in range(top + 1)]

    def _add(self, capacity: int, step: int) -> None:
        at = self.leaves + capacity
        while at:
            self.count[at] += step
            at >>= 1

    def push(self, capacity: int, bin_) -> None:
        self.bins[capacity].append(bin_)
        self._add(capacity, 1)

    def pop(self, capacity: int):
        self._add(capacity, -1)
        return self.bins[capacity].pop()

    def tightest(self, need: int) -> int:
        """-1 if no open bin has room."""
        count, at = self.count, self.leaves + need
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):
                at >>= 1
            if at <= 1:
                return -1
            at += 1
            while at < self.leaves:
                at = 2 * at if count[2 * at] else 2 * at + 1
        return at - self.leaves


RUN = ("length", "first", "each", "bin", "offset")


def plan(counts: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Best-fit decreasing of `counts[n]` pieces of each length n, in runs: from
    the piece numbered `first` of its length on, `each` pieces go to each of the
    bins from `bin` on, behind `offset`.

    Equal pieces in turn fill the tightest open bin as long as they fit, then
    the next of that capacity, so a class of equal bins takes a run at once. The
    result is that of one pass over all pieces, and its size does not grow with
    their number."""
    tree, runs, used = Capacities(capacity), [], 0
    for need in sorted(counts, reverse=True):
        first, left = 0, counts[need]
        while left:
            room = tree.tightest(need)
            if room < 0:
                room = capacity
                bin_, n = used, -(-left // (capacity // need))
                used += n
            else:
                bin_, n = tree.pop(room)
            most = room // need
            # whole bins, then one bin with what is left
            for each, bins in ((most, min(n, left // most)), (left % most, 1 if left < n * most else 0)):
                if each and bins:
                    runs.append((need, first, each, bin_, capacity - room))
                    if room > each * need:
                        tree.push(room - each * need, (bin_, bins))
                    first, left, bin_, n = first + each * bins, left - each * bins, bin_ + bins, n - bins
            if n:
                tree.push(room, (bin_, n))
    return {c: np.array([r[i] for r in runs], "int64") for i, c in enumerate(RUN)}


def place(runs: dict[str, np.ndarray], lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of pieces, each given by its length and its number among
    those of that length."""
    order = np.lexsort((runs["first"], runs["length"]))
    r = {c: v[order] for c, v in runs.items()}
    at = np.empty(len(lengths), "int64")
    for n in np.unique(lengths):
        own = lengths == n
        lo, hi = np.searchsorted(r["length"], [n, n + 1])
        at[own] = lo + np.searchsorted(r["first"][lo:hi], numbers[own], "right") - 1
    i = numbers - r["first"][at]
    return r["bin"][at] + i // r["each"][at], r["offset"][at] + i % r["each"][at] * lengths


def ranks(lengths: np.ndarray) -> np.ndarray:
    """Number of each element among the equal ones of a sorted array."""
    starts = np.flatnonzero(np.concatenate([[True], lengths[1:] != lengths[:-1]])) if len(lengths) else np.empty(0, "int64")
    return np.arange(len(lengths)) - np.repeat(starts, np.diff(np.append(starts, len(lengths))))


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing of lengths given in falling order: bin and offset of each."""
    every, n = np.unique(lengths, return_counts=True)
    return place(plan(dict(zip(every.tolist(), n.tolist())), capacity), np.asarray(lengths), ranks(np.asarray(lengths)))


def pack(pieces: DataFrame, capacity: int, pieces_per_task: int = 32_768) -> DataFrame:
    """Place pieces (columns of PIECES) into sequences of at most `capacity`,
    best-fit decreasing over all of them.

    The pass runs over the counts of the at most `capacity` lengths. Spark deals
    the pieces by a hash of all their columns into slices of about
    `pieces_per_task`; a slice's pieces of a length are numbered behind those of
    the slices before it, which tells each its place. Ties go by doc_id and
    piece; reruns give the same placement. Pieces of length 0 cannot occur, as
    each document ends with the end id."""
    sizes = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    tasks = max(1, -(-sum(sizes.values()) // pieces_per_task))
    runs = pieces.sparkSession.sparkContext.broadcast(plan(sizes, capacity))
    # a hash of the contents is stable under retries, unlike round-robin
    dealt = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length"), F.lit(tasks)))
    before = F.sum("n").over(W.partitionBy("length").orderBy("slice")) - F.col("n")
    skips = dealt.groupBy("slice", "length").agg(F.count("*").alias("n")).select("slice", "length", before.alias("skip"))

    def run(key, own):
        own = own.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = own["length"].to_numpy()
        bins, offsets = place(runs.value, lengths, own["skip"].to_numpy() + ranks(lengths))
        return own.drop(["slice", "skip"]).append_column("sequence_id", pa.array(bins)).append_column("offset", pa.array(offsets))

    return dealt.join(skips, ["slice", "length"]).select(*dealt.columns, "skip").groupBy("slice").applyInArrow(run, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, pieces_per_task: int = 32_768) -> DataFrame:
    """Tokenise, cut and pack `docs` (doc_id, text; other columns are ignored).

    Result: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null
    and empty texts become a piece of the end id alone; repeated rows are packed
    once each; an empty table gives no rows; a null doc_id is kept as null."""
    pieces = stored(cut_pieces(docs, tokenizer, capacity, end_id), "pieces")
    return pack(pieces, capacity, pieces_per_task)
