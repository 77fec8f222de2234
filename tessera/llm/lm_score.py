"""Cross-entropy difference of matched n-gram models."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import Members, slices, stored

#: Words that the added one of the unigrams is spread over at least; a corpus
#: with more distinct words spreads it over all of them.
VOCABULARY = 2048
START = 0
#: Words with at least one in WORDS of all tokens, so WORDS of them at most,
#: have a number and their sums are sent to all tasks; the sums of the others
#: are joined.
WORDS = 1 << 21
#: Bigrams with at least one in HOT of all tokens, so HOT of them at most, are
#: scored from a broadcast; the others where their counts are.
HOT = 1 << 17
DISCOUNT = 0.75
CACHE = 100_000
#: Tokens that a task holds at once, and tokens a part of the bigrams.
RUN, PART = 1 << 18, 1 << 20
#: Bigrams whose losses are worked out at once.
STEP = 1 << 16
MOST_TASKS = 20_000
#: The highest bit marks words without a number.
RARE = np.uint64(1 << 63)

#: What a row of a part holds.
COUNTS, CONTEXT, FREQUENT, WANTED, PLACES, TEXTS, SUMS = range(7)
COUNTED, PLACED = ("uint64", "uint64", "uint32", "uint32"), ("uint64", "uint64", "uint32")
TEXT, SUMMED = ("int64", "uint8", "int64", "float64", "float64"), ("uint32", "float32", "float32")
ROW = "kind int, part int, run long, blob binary, x long, y long, target long, background long, target_kinds long, background_kinds long"
NAMES = [c.split()[0] for c in ROW.split(", ")]


class Hashes(dict):
    """word -> 64-bit hash; holds the CACHE last met."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found

    def words(self, text: str) -> np.ndarray:
        split = text.lower().split()
        return np.fromiter(map(self.__getitem__, split), "uint64", len(split))


def numbered(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The number, from 1, of words whose hash is among the sorted `known`; the
    hash of others, with the highest bit set."""
    if not len(known):
        return hashes | RARE
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, (at + 1).astype("uint64"), hashes | RARE)


def coded(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Key of each bigram."""
    return (before << np.uint64(21) | before >> np.uint64(43)) ^ ids


def part_of(before: np.ndarray, ids: np.ndarray, parts: int) -> np.ndarray:
    """A rare context has all its bigrams in one part, and so has a rare word
    behind frequent ones; other bigrams are spread by both words."""
    key = np.where(before >= RARE, before, np.where(ids >= RARE, ids, coded(before, ids)))
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype("int64") % parts


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, byte by byte of all rows, compressed."""
    planes = [np.ascontiguousarray(c).view("uint8").reshape(len(c), c.dtype.itemsize).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, kinds) -> list[np.ndarray]:
    widths = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "uint8")
    n, at, out = len(raw) // sum(widths), 0, []
    for kind, w in zip(kinds, widths):
        out.append(np.ascontiguousarray(raw[at : at + w * n].reshape(w, n).T).reshape(-1).view(kind))
        at += w * n
    return out


def by_part(before, ids, others, parts):
    """part and packed bigrams, in the order given, of each part; the contexts as
    differences."""
    part = part_of(before, ids, parts)
    # small numbers are sorted by radix
    order = np.argsort(part.astype("uint16") if parts <= 1 << 16 else part, kind="stable")
    part, before, ids, others = part[order], before[order], ids[order], [o[order] for o in others]
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=parts))
    for a, z in zip(edges, edges[1:]):
        yield int(part[a]), pack(np.diff(before[a:z], prepend=np.uint64(0)), ids[a:z], *[o[a:z] for o in others])


def bigrams(blob: bytes, kinds) -> list[np.ndarray]:
    before, *rest = unpack(blob, kinds)
    return [np.cumsum(before, dtype="uint64"), *rest]


def rows(**columns) -> pa.RecordBatch:
    """A batch of ROW; columns that are not given are null."""
    n = max(len(v) for v in columns.values() if not np.isscalar(v))
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    cols = []
    for c in ROW.split(", "):
        name, kind = c.split()
        v = columns.get(name)
        cols.append(pa.nulls(n, types[kind]) if v is None else pa.array(np.full(n, v) if np.isscalar(v) else v, types[kind]))
    return pa.RecordBatch.from_arrays(cols, NAMES)


def runs(batches, known: np.ndarray):
    """Rows without their text, word before and word of all their texts in a row,
    and the number of words of each, for about RUN tokens at a time."""
    hashes, held, words, size = Hashes(), [], [], 0

    def done():
        n = np.array([len(w) for w in words], "int64")
        ids = numbered(np.concatenate(words), known)
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[(np.cumsum(n) - n)[n > 0]] = START
        return pa.Table.from_batches(held), before, ids, n

    for b in batches:
        words += map(hashes.words, b["text"].to_pylist())
        held.append(b.drop_columns(["text"]))
        size += sum(map(len, words[-b.num_rows :]))
        if size >= RUN:
            yield done()
            held, words, size = [], [], 0
    if words:
        yield done()


def marked_here(batches, some: Members):
    """text and is_target of rows that are marked already (no `_h`) or that the
    filter of target ids rejects by `_h`; the rest come again, joined."""
    for b in batches:
        h = b["_h"]
        rejected = ~some.maybe(h.fill_null(0).to_numpy(zero_copy_only=False))
        kept = b.filter(pa.array(rejected | h.is_null().to_numpy(zero_copy_only=False)))
        if kept.num_rows:
            yield kept.select(["text", "is_target"])


def word_counts(docs: DataFrame, some: Members) -> DataFrame:
    """word (its hash), target and background counts; docs: text, is_target and
    `_h`. Summed in each slice before the shuffle."""

    def run(batches):
        hashes = Hashes()
        for b in marked_here(slices(batches, 2048), some):
            each = list(map(hashes.words, b["text"].to_pylist()))
            ids = np.concatenate(each)
            wanted = np.repeat(np.array(b["is_target"].to_pylist(), "bool"), [len(e) for e in each])
            every, where = np.unique(ids, return_inverse=True)
            found = [np.bincount(where[wanted], minlength=len(every)), np.bincount(where, minlength=len(every))]
            yield pa.RecordBatch.from_arrays([pa.array(every.view("int64")), *map(pa.array, found)], ["word", "target", "background"])

    found = docs.select("text", "is_target", "_h").mapInArrow(run, "word long, target long, background long")
    return found.groupBy("word").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def bigram_parts(docs: DataFrame, some: Members, known, parts: int, tokens: int) -> DataFrame:
    """ROWs of each part: its bigrams with both counts, packed in one row; sums
    of its frequent contexts; its frequent bigrams; and the rare words whose
    sums it needs. Counts are summed in each run before the shuffle."""

    def run(batches):
        for held, before, ids, n in runs(marked_here(slices(batches, 1024), some), known.value):
            wanted = np.repeat(held["is_target"].to_numpy(), n).astype("bool")
            every, first, where = np.unique(coded(before, ids), return_index=True, return_inverse=True)
            counts = [np.bincount(where[wanted], minlength=len(every)).astype("uint32"), np.bincount(where, minlength=len(every)).astype("uint32")]
            found = list(by_part(before[first], ids[first], counts, parts))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["part", "blob"])

    def merge(group):
        part = group["part"][0].as_py()
        before, ids, *counts = (np.concatenate(c) for c in zip(*(bigrams(b, COUNTED) for b in group["blob"].to_pylist())))
        code = coded(before, ids)
        order = np.argsort(code)
        first = np.flatnonzero(np.diff(code[order], prepend=~code[order[:1]]))
        t, b = (np.add.reduceat(c[order], first, dtype="int64") for c in counts)
        first = order[first]
        before, ids = before[first], ids[first]
        del code, order, counts
        out = [rows(kind=COUNTS, part=part, blob=[blob]) for _, blob in by_part(before, ids, [t.astype("uint32"), b.astype("uint32")], 1)]
        frequent = before < RARE
        contexts, at = np.unique(before[frequent], return_inverse=True)
        total = lambda x: np.bincount(at, x[frequent], len(contexts)).astype("int64")
        if len(contexts):
            out.append(rows(kind=CONTEXT, x=contexts.view("int64"), target=total(t), background=total(b), target_kinds=total(t > 0), background_kinds=total(b > 0)))
        hot = b * HOT >= tokens
        if hot.any():
            out.append(rows(kind=FREQUENT, x=before[hot].view("int64"), y=ids[hot].view("int64"), target=t[hot], background=b[hot]))
        rare = np.unique(ids[ids >= RARE])
        if len(rare):
            out.append(rows(kind=WANTED, part=part, x=rare.view("int64")))
        return pa.Table.from_batches(out)

    packed = docs.select("text", "is_target", "_h").mapInArrow(run, "part int, blob binary")
    return packed.repartition(min(parts, MOST_TASKS), "part").groupBy("part").applyInArrow(merge, ROW)


def loss(n, total, kinds, word, spread):
    """Absolute discounting, backed off to a unigram with one added to each word."""
    rest = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
    return -np.log(np.maximum(n - DISCOUNT, 0) / np.maximum(total, 1) + rest * (word + 1) / spread)


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, target: str = "quality = 1") -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss and score of each row.

    The background model counts all of `docs`, the target model those that
    `labels` marks by `target`; both are bigram models of the same vocabulary
    (every word of the corpus, by 64-bit hash), the same order and smoothing. A
    document's losses are its mean negative log probability a token under each
    model, in nats; score is target minus background: the lower, the more like
    the target.

    Bigrams are dealt to parts by hash and their counts stay there, packed. The
    sums of at most WORDS frequent words and the losses of at most HOT frequent
    bigrams are sent to all tasks; every other bigram of a document is sent to
    its part, packed with those of its run of documents, and its losses come
    back summed by document. Sums of rare words are joined to the parts that
    have them, so no word or bigram is left out at any size.

    Null, empty and blank texts have n_tokens 0 and null losses and score.
    Without any target document the target model is the uniform one. Rows that
    repeat a doc_id are scored each; extra columns are ignored; an empty table
    gives none."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    marked = labels.filter(F.expr(target)).select("doc_id").distinct().withColumn("is_target", F.lit(True))
    # a filter of fixed size holds the target ids; texts that it rejects are not joined
    marked = stored(marked.withColumn("_h", F.xxhash64(F.col("doc_id").cast("long"))), "targets")
    some = Members(marked, "_h")
    hashed = texts.withColumn("_h", F.xxhash64("doc_id"))
    asked = hashed.filter(some.column("_h")).join(marked.select("doc_id", "is_target"), "doc_id", "left")
    asked = asked.select("text", F.coalesce("is_target", F.lit(False)).alias("is_target"), F.lit(None).cast("long").alias("_h"))
    flagged = asked.unionByName(hashed.select("text", F.lit(False).alias("is_target"), "_h"))

    words = stored(word_counts(flagged, some), "words")
    models = ("target", "background")
    size = words.agg(F.count("*").alias("words"), *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in models]).first()
    tokens = size["background"]
    spread = {m: float(size[m] + max(VOCABULARY, size["words"])) for m in models}
    frequent = F.col("background") * WORDS >= tokens
    top = words.filter(frequent).toArrow()
    hashes = top["word"].to_numpy().view("uint64")
    order = np.argsort(hashes)
    known = spark.sparkContext.broadcast(hashes[order])
    parts = tokens // PART + 1

    table = stored(bigram_parts(flagged, some, known, parts, tokens), "bigrams")
    kind = F.col("kind")
    sums = [F.sum(c).alias(c) for c in NAMES[6:]]
    contexts = table.filter(kind == CONTEXT).groupBy("x").agg(*sums).toArrow()
    stats = {f"{m}_word": np.concatenate([[0], top[m].to_numpy()[order]]).astype("float64") for m in models}
    for m in models:
        for name, column in ((f"{m}_total", m), (f"{m}_kinds", f"{m}_kinds")):
            stats[name] = np.zeros(len(hashes) + 1)
            stats[name][contexts["x"].to_numpy()] = contexts[column].to_numpy()
    hot = table.filter(kind == FREQUENT).select("x", "y", *models).toArrow()
    x, y = (hot[c].to_numpy() for c in "xy")
    keys = coded(x.view("uint64"), y.view("uint64"))
    by_key = np.argsort(keys)
    both = [loss(hot[m].to_numpy(), stats[f"{m}_total"][x], stats[f"{m}_kinds"][x], stats[f"{m}_word"][y], spread[m])[by_key] for m in models]
    shared, sent = spark.sparkContext.broadcast([keys[by_key], *both]), spark.sparkContext.broadcast(stats)

    def place(batches):
        """For each run of texts a row with their lengths and sums over frequent
        bigrams, and a row of its other bigrams for each part."""
        (keys, *both), at_task = shared.value, TaskContext.get().partitionId()
        for k, (held, before, ids, n) in enumerate(runs(slices(batches, 1024), known.value)):
            run, code = at_task << 32 | k, coded(before, ids)
            at = np.minimum(np.searchsorted(keys, code), max(len(keys) - 1, 0))
            found = keys[at] == code if len(keys) else np.zeros(len(code), "bool")
            doc = np.repeat(np.arange(len(n)), n)
            near = [np.bincount(doc[found], m[at[found]], len(n)) for m in both]
            named = held["doc_id"].combine_chunks()
            blob = pack(named.fill_null(0).to_numpy(zero_copy_only=False), named.is_null().to_numpy(zero_copy_only=False).astype("uint8"), n, *near)
            yield rows(kind=TEXTS, part=run % parts, run=run, blob=[blob])
            left = np.flatnonzero(~found)
            left = left[np.argsort(code[left])]
            other = list(by_part(before[left], ids[left], [doc[left].astype("uint32")], parts))
            if other:
                yield rows(kind=PLACES, part=[p for p, _ in other], run=run, blob=[b for _, b in other])

    def look_up(group):
        """Losses of a part's bigrams, summed by run and text."""
        kinds, stats = group["kind"].to_numpy(), sent.value
        of = lambda kind: group.filter(pa.array(kinds == kind))
        out = [rows(kind=TEXTS, run=of(TEXTS)["run"].to_numpy(), blob=of(TEXTS)["blob"].to_pylist())]
        places = of(PLACES)
        if places.num_rows:
            before, ids, *counts = bigrams(of(COUNTS)["blob"][0].as_py(), COUNTED)
            wanted = of(WANTED).sort_by("x")
            rare, words = np.flatnonzero(before >= RARE), wanted["x"].to_numpy()
            contexts, at_context = np.unique(before[rare], return_inverse=True)
            own = [[np.bincount(at_context, x[rare], len(contexts)) for x in (n, n > 0)] for n in counts]
            both = np.empty((2, len(ids)), "float32")
            for lo in range(0, len(ids), STEP):  # temporaries of a step only
                step = slice(lo, lo + STEP)
                x, y = before[step], ids[step]
                x_rare, y_rare = x >= RARE, y >= RARE
                at_word, at_own = np.searchsorted(words, y[y_rare].view("int64")), np.searchsorted(contexts, x[x_rare])
                plain = np.where(x_rare, 0, x).astype("int64"), np.where(y_rare, 0, y).astype("int64")
                for k, (m, n) in enumerate(zip(models, counts)):
                    word = stats[f"{m}_word"][plain[1]]
                    word[y_rare] = wanted[m].to_numpy()[at_word]
                    total, kinds_of = (stats[f"{m}_{c}"][plain[0]] for c in ("total", "kinds"))
                    for sums, found in zip((total, kinds_of), own[k]):
                        sums[x_rare] = found[at_own]
                    both[k, step] = loss(n[step].astype("float64"), total, kinds_of, word, spread[m])
            keys, blobs = coded(before, ids), []  # in order, as they were merged
            del before, ids, counts
            for blob in places["blob"].to_pylist():
                before, ids, doc = bigrams(blob, PLACED)
                at = np.searchsorted(keys, coded(before, ids))
                docs = np.unique(doc)
                blobs.append(pack(docs, *[np.bincount(doc, x[at])[docs].astype("float32") for x in both]))
            out.append(rows(kind=SUMS, run=places["run"].to_numpy(), blob=blobs))
        return pa.Table.from_batches(out).select(["kind", "run", "blob"])

    def finish(group):
        kinds, blobs = group["kind"].to_pylist(), group["blob"].to_pylist()
        ids, null, n, t, b = (c.copy() for c in unpack(blobs[kinds.index(TEXTS)], TEXT))
        for kind, blob in zip(kinds, blobs):  # every text of a run is in its row of TEXTS
            if kind == SUMS:
                doc, x, y = unpack(blob, SUMMED)
                t[doc] += x
                b[doc] += y
        t, b = t / np.maximum(n, 1), b / np.maximum(n, 1)
        cols = [pa.array(ids, mask=null.astype("bool")), pa.array(n), *[pa.array(c, mask=n == 0) for c in (t, b, t - b)]]
        return pa.Table.from_arrays(cols, ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    rare = words.filter(~frequent).select(F.col("word").bitwiseOR(F.lit(-(1 << 63))).alias("x"), *models)
    wanted = table.filter(kind == WANTED).select("kind", "part", "x").join(rare, "x")
    blank = {c.split()[0]: F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in ROW.split(", ")}
    wanted = wanted.select(*[c if c in ("kind", "part", "x", *models) else blank[c] for c in NAMES])
    every = texts.mapInArrow(place, ROW).unionByName(table.filter(kind == COUNTS)).unionByName(wanted)
    every = every.select("kind", "part", "run", "blob", "x", *models)
    tasks = min(parts, MOST_TASKS)
    found = every.repartition(tasks, "part").groupBy("part").applyInArrow(look_up, "kind int, run long, blob binary")
    return found.repartition(tasks, "run").groupBy("run").applyInArrow(finish, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")
