"""What filters cost each other: every order of a set of filters, from posting lists."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from tessera.llm.common import slices, stored

#: Row numbers a posting list spans at most: 2 to this power.
RANGE_BITS = 13
UPPER = bytes(range(ord("A"), ord("Z") + 1))
MARK = re.compile(rb"[#$%&*|]").search
TEXT_FILTERS = "ABCDE"
#: Texts with more than one in HOT of all rows, so fewer than HOT of them, are
#: looked up by a broadcast; the others in a join.
HOT = 10_000


# ---- sorted lists


def gallop(ids: list, wanted, at: int) -> int:
    """First place from `at` on whose id is not below `wanted`, by steps that
    double and a binary search in the last of them."""
    step, n = 1, len(ids)
    while at + step < n and ids[at + step] < wanted:
        at += step
        step *= 2
    return bisect_left(ids, wanted, at, min(n, at + step + 1))


def union(lists: list[list]) -> list:
    """Ids of any of the sorted lists. The list with the smallest head gives all
    ids up to the next list's head at once."""
    live, out = [[ids, 0] for ids in lists if ids], []
    while len(live) > 1:
        live.sort(key=lambda x: x[0][x[1]])
        (ids, at), (other, place) = live[0], live[1]
        bound = other[place]
        upto = gallop(ids, bound, at)
        out += ids[at:upto]
        live[0][1] = upto + (upto < len(ids) and ids[upto] == bound)
        live = [x for x in live if x[1] < len(x[0])]
    return out + live[0][0][live[0][1] :] if live else out


def difference(ids: list, gone: list) -> list:
    """Ids that `gone` does not hold, both sorted."""
    out, at, place = [], 0, 0
    while at < len(ids):
        place = gallop(gone, ids[at], place) if place < len(gone) else place
        if place == len(gone):
            return out + ids[at:]
        upto = gallop(ids, gone[place], at)
        out += ids[at:upto]
        at = upto + (upto < len(ids) and ids[upto] == gone[place])
    return out


def common(ids: list, others: list) -> int:
    """Number of ids in both sorted lists."""
    return len(ids) - len(difference(ids, others))


# ---- the filters


def text_failures(docs: DataFrame) -> DataFrame:
    """doc_id, part (lang; null: the empty string), a number of each row and
    booleans A to E: whether it fails that filter.

    A: under 100 words; B: under 80 % distinct words; C: over 10 % capitals A-Z;
    D: holds one of #$%&*|; E: its text is that of a smaller doc_id, of any
    part. Words are runs without blank, tab, LF, VT, FF and CR. A null text is
    the empty text. A null doc_id is neither smaller nor larger than another,
    so E does not fail for it or by it; rows that repeat a doc_id are judged
    each, and none of them makes another fail E. Only digests of texts are
    shuffled; a text's smallest doc_id is found by partial sums, and rows of the
    few texts with very many copies are not shuffled by it."""

    def run(batches):
        for b in slices(batches, 2048):
            texts, bits, digests = b["text"], [], []
            for raw, chars in zip(texts.cast(pa.binary()).to_pylist(), pc.utf8_length(texts).to_pylist()):
                words = raw.split()
                capitals = len(raw) - len(raw.translate(None, UPPER))
                bits.append((len(words) < 100) | (100 * len(set(words)) < 80 * len(words)) << 1 | (100 * capitals > 10 * chars) << 2 | bool(MARK(raw)) << 3)
                digests.append(hashlib.blake2b(raw, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["part"], pa.array(bits, pa.int32()), pa.array(digests, pa.binary())], ["doc_id", "part", "bits", "digest"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    checked = rows.mapInArrow(run, "doc_id long, part string, bits int, digest binary")
    checked = stored(checked.withColumn("row", F.monotonically_increasing_id()), "filter-bits")
    copies = checked.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("last > first")
    copies = stored(copies.select("digest", "first", "n"), "filter-copies")
    hot = F.broadcast(copies.filter(F.col("n") * HOT > checked.count()).select("digest", F.col("first").alias("hot")))
    known = checked.join(hot, "digest", "left")
    rest = known.filter("hot IS NULL").join(copies.select("digest", "first"), "digest", "left")
    every = known.filter("hot IS NOT NULL").withColumn("first", F.col("hot")).unionByName(rest)
    failed = [(F.col("bits").bitwiseAND(1 << k) != 0).alias(f) for k, f in enumerate(TEXT_FILTERS[:4])]
    return every.select("doc_id", "part", "row", *failed, F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("E"))


def marked(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with good (a label says quality 1) and toxic (one says toxic 1)."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    known = known.filter("good OR toxic")
    return rows.join(known, "doc_id", "left").na.fill(False, ["good", "toxic"])


# ---- the audit


def postings(rows: DataFrame, filters: str) -> DataFrame:
    """part, the number of rows n and, for each filter, good and toxic, the
    sorted list of row numbers: one row for each part and range of numbers, so
    a list has at most 2^RANGE_BITS of them however large its part."""
    of = lambda c: F.array_sort(F.collect_list(F.when(F.col(c), F.col("row")))).alias(c)
    span = F.shiftright("row", RANGE_BITS).alias("span")
    return rows.groupBy("part", span).agg(F.count("*").alias("n"), *map(of, [*filters, "good", "toxic"]))


def removals(lists: DataFrame, filters: str) -> DataFrame:
    """part, before (bits of the filters applied earlier), filter, n and the rows
    that the filter removes then: all, good and toxic ones."""
    k = len(filters)

    def run(batches):
        for b in batches:
            names = {c: b[c].to_pylist() for c in [*filters, "good", "toxic"]}
            out = []
            for at, (part, n) in enumerate(zip(b["part"].to_pylist(), b["n"].to_pylist())):
                own = [names[f][at] for f in filters]
                good, toxic = names["good"][at], names["toxic"][at]
                for before in range(1 << k):
                    gone = union([own[i] for i in range(k) if before >> i & 1])
                    for i in range(k):
                        if not before >> i & 1:
                            here = difference(own[i], gone)
                            out.append((part, before, filters[i], n, len(here), common(here, good), common(here, toxic)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], NAMES)

    NAMES = ["part", "before", "filter", "n", "removed", "good", "toxic"]
    found = lists.mapInArrow(run, "part string, before long, filter string, n long, removed long, good long, toxic long")
    return found.groupBy(*NAMES[:3]).agg(*[F.sum(c).alias(c) for c in NAMES[3:]])


def audit(rows: DataFrame, filters: str) -> DataFrame:
    """One row for each part, order of the filters and step.

    rows: part, row (a number of its own for each row), a boolean for each letter
    of `filters`, good and toxic; more columns are ignored. Result: part,
    filter_order, step, and of the part's rows: kept after the step, removed in
    it, redundant (fail its filter, removed before), unique_fails (fail its
    filter alone), good_lost, toxic_lost, and shapley, the sum of what its filter
    removes over all orders. An empty table gives none.

    Failing rows are kept as sorted posting lists of bounded ranges of row
    numbers; every set of earlier filters is a k-way union of them, what a
    filter removes behind it a difference, and sizes add up over ranges. What a
    step removes hangs on the set of earlier filters only, so the orders (a
    fixed table of factorial size in the filters) are joined to the sums."""
    k = len(filters)
    everything = (1 << k) - 1
    alone = F.col("before") == F.lit(everything) - F.element_at(F.create_map(*[F.lit(x) for i, f in enumerate(filters) for x in (f, 1 << i)]), F.col("filter"))
    # a set of m earlier filters stands before a filter in m! (k - 1 - m)! orders
    orders_of = F.element_at(F.array(*[F.lit(math.factorial(m) * math.factorial(k - 1 - m)) for m in range(k)]), F.bit_count("before") + 1)
    of = W.partitionBy("part", "filter")
    sums = stored(removals(postings(rows, filters), filters), "filter-sums").select(
        "*",
        F.max(F.when(F.col("before") == 0, F.col("removed"))).over(of).alias("fails"),
        F.max(F.when(alone, F.col("removed"))).over(of).alias("unique_fails"),
        F.sum(F.col("removed") * orders_of).over(of).alias("shapley"),
    )
    steps = [(f"{''.join(o)}", s + 1, o[s], sum(1 << filters.index(x) for x in o[:s])) for o in permutations(filters) for s in range(k)]
    orders = rows.sparkSession.createDataFrame(steps, "filter_order string, step int, filter string, before long")
    upto = W.partitionBy("part", "filter_order").orderBy("step").rowsBetween(W.unboundedPreceding, W.currentRow)
    return sums.join(F.broadcast(orders), ["before", "filter"]).select(
        "part",
        "filter_order",
        "step",
        (F.col("n") - F.sum("removed").over(upto)).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails",
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        "shapley",
    )


def audit_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five text filters over whole `docs`, with what `labels`
    says of them. No filter switches off: parts without a failure have zeros."""
    return audit(marked(text_failures(docs), labels), TEXT_FILTERS)
