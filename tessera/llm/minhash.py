"""Near-duplicate documents by ProbMinHash on weighted word shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import Members, cut, small_slices, stored
from tessera.llm.components import connected_components

# Odd multipliers of the splitmix64 finalizer (fixed values).
MIX_A, MIX_B, GOLDEN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
WORD_CACHE = 200_000
#: Bits of an arrival that pick its register; registers are 2 to their power at most.
REGISTER_BITS = 24


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64 of each element."""
    x = x + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """word -> 64-bit hash, of bounded size; each task has its own, so that a
    worker that goes on to another stage does not keep it."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        self[word] = h
        return h


def shingles(text: str, size: int, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of `size` words of a whole text, and how often
    each occurs. Words are lower-cased and cut at white space; a text of fewer
    words is one shingle; one without words has none."""
    found = text.lower().split()
    if not found:
        return np.empty(0, "uint64"), np.empty(0, "int64")
    w = np.fromiter(map(words.__getitem__, found), "uint64", len(found))
    if len(w) > size:
        n = len(w) - size + 1
        h = np.zeros(n, "uint64")
        for k in range(size):
            h = mixed(h ^ w[k : k + n])
    else:
        h = np.zeros(1, "uint64")
        for x in w:
            h = mixed(h ^ x)
    return np.unique(h, return_counts=True)


def prob_minhash(hashes: np.ndarray, weights: np.ndarray, registers: int) -> np.ndarray:
    """Signature of a weighted set: two sets agree in a register with their
    probability Jaccard similarity.

    Each element is a Poisson process of rate proportional to its weight; an
    arrival goes to a random register, which keeps the element that came first.
    Arrivals come a few at a time for all elements at once; an element is done
    as soon as its time is past the latest register. About registers *
    log(registers) arrivals fill the registers, so a set of hundreds of elements
    needs two or three each and a long one mostly one."""
    if not 0 < registers <= 1 << REGISTER_BITS:
        raise ValueError(f"registers: 1 to {1 << REGISTER_BITS}, not {registers}")
    first, owner = np.full(registers, np.inf), np.zeros(registers, "uint64")
    item, rate, time, at = hashes, weights.astype("float64"), np.zeros(len(hashes)), 0
    while len(item):
        each = max(1, int(np.ceil(registers * (np.log(registers) + 1) / len(hashes)))) if not at else 2
        state = mixed(item[:, None] + (np.arange(at, at + each, dtype="uint64") * MIX_A)[None, :])
        at += each
        # the lower bits give the register, the others the waiting time
        wait = -np.log(((state >> np.uint64(REGISTER_BITS)).astype("float64") + 0.5) * 2.0 ** (REGISTER_BITS - 64)) / rate[:, None]
        times = np.cumsum(wait, axis=1) + time[:, None]
        place = ((state & np.uint64((1 << REGISTER_BITS) - 1)).astype("int64") * registers) >> REGISTER_BITS
        np.minimum.at(first, place.ravel(), times.ravel())
        row, col = np.nonzero(times == first[place])
        owner[place[row, col]] = item[row]
        time = times[:, -1]
        go = time < first.max()
        item, rate, time = item[go], rate[go], time[go]
    return owner


def probability_jaccard(a, wa, b, wb) -> float:
    """Exact J_P of two weighted sets (sorted distinct hashes, weights):
    the sum over common i of 1 / sum_j max(p_j / p_i, q_j / q_i), by sorting on
    p / q."""
    if not len(a) or not len(b):
        return 0.0
    both, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    p, q = wa / wa.sum(), wb / wb.sum()
    pi, qi = p[ia], q[ib]
    only_p, only_q = 1 - pi.sum(), 1 - qi.sum()
    ratio = pi / qi
    order = np.argsort(ratio, kind="stable")
    pi, qi = pi[order], qi[order]
    above = pi[::-1].cumsum()[::-1] + only_p  # sum of p_j with a ratio not below
    below = np.concatenate([[0.0], qi.cumsum()[:-1]]) + only_q
    return float((1 / (above / pi + below / qi)).sum())


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, digest of the text and `row`, a hash of id and digest."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return base.withColumn("digest", F.unhex(F.md5("text"))).withColumn("row", F.xxhash64("doc_id", "digest"))


def signatures(texts: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, row, digest and one 64-bit key for each band of each row of
    `keyed`; digest and keys are null for a text without words."""

    def run(batches):
        words = Words()
        for b in small_slices(batches, 512):
            keys, digests, seen = [], [], {}
            for text, digest in zip(b["text"].to_pylist(), b["digest"].to_pylist()):
                if digest not in seen:
                    h, w = shingles(text, size, words)
                    seen[digest] = None
                    if len(h):
                        sig = prob_minhash(h, w, bands * rows).reshape(bands, rows)
                        key = np.arange(bands, dtype="uint64")  # a key holds its band's number
                        for k in range(rows):
                            key = mixed(key ^ sig[:, k])
                        seen[digest] = key.view("int64")
                keys.append(seen[digest])
                digests.append(None if seen[digest] is None else digest)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["row"], pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "row", "digest", "keys"])

    return texts.select("doc_id", "row", "digest", "text").mapInArrow(run, "doc_id long, row long, digest binary, keys array<long>")


def weighted(texts: DataFrame, size: int, wanted: "Members | None" = None) -> DataFrame:
    """digest, hashes and weights of each row of `keyed` that may be in `wanted`."""

    def run(batches):
        words = Words()
        for b in small_slices(batches, 512):
            if wanted is not None:
                b = b.filter(pa.array(wanted.maybe(b["row"].to_numpy())))
            got = [shingles(t, size, words) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["digest"], pa.array([h.view("int64") for h, _ in got], pa.list_(pa.int64())), pa.array([w.astype("int32") for _, w in got], pa.list_(pa.int32()))],
                ["digest", "hashes", "weights"],
            )

    return texts.select("row", "digest", "text").mapInArrow(run, "digest binary, hashes array<long>, weights array<int>")


def _sets(table, name_h: str, name_w: str) -> list:
    return [(h.values.to_numpy().view("uint64"), w.values.to_numpy()) for h, w in zip(table[name_h], table[name_w])]


def verified(edges: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The edges (a, b) whose exact probability Jaccard reaches `threshold`;
    a join that splits hot keys brings the shingles of each side."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"), F.col("weights").alias("wa"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"), F.col("weights").alias("wb"))

    def run(batches):
        for t in batches:
            keep = [probability_jaccard(*x, *y) >= threshold for x, y in zip(_sets(t, "ha", "wa"), _sets(t, "hb", "wb"))]
            yield t.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return edges.join(left, "a").join(right, "b").select("a", "b", "ha", "wa", "hb", "wb").mapInArrow(run, "a long, b long")


def across(shared: DataFrame, parts: DataFrame, sets: DataFrame, threshold: float, block: int) -> DataFrame:
    """Links (a, b) between members of one bucket that are in different
    components so far, each pair checked exactly.

    Members of a bucket's largest component need not meet each other, only the
    outsiders. So outsiders, about `block` a task, meet all members, about
    `block` a task: one outsider of a bucket of n costs n checks and is copied
    n / block times, the others once. A task returns only links that join two
    components."""
    now = shared.join(parts, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    sizes = now.groupBy("key", "component").agg(F.count("*").alias("n"))
    most = F.max(F.struct("n", "component"))
    open_ = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("kinds"), most.alias("most")).filter("kinds > 1 AND n > 2")
    cuts = lambda n: F.ceil(n / block).cast("int")
    open_ = open_.select("key", F.col("most.component").alias("top"), cuts(F.col("n")).alias("is"), cuts(F.col("n") - F.col("most.n")).alias("js"))
    rows = now.join(open_, "key").withColumn("out", F.col("component") != F.col("top"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = rows.select("key", F.pmod(F.xxhash64("node"), "is").cast("int").alias("i"), every("js").alias("j"), F.lit(False).alias("seeks"), "node", "component", "out")
    seekers = rows.filter("out").select("key", every("is").alias("i"), F.pmod(F.xxhash64("component", "node"), "js").cast("int").alias("j"), F.lit(True).alias("seeks"), "node", "component", "out")
    full = members.union(seekers).join(sets, "node")

    def run(key, t):
        t = t.sort_by("node").combine_chunks()
        nodes, comp, out, seeks = (t[c].to_pylist() for c in ("node", "component", "out", "seeks"))
        got = _sets({c: t[c].combine_chunks() for c in ("hashes", "weights")}, "hashes", "weights")
        up = {c: c for c in comp}

        def root(c):
            while up[c] != c:
                c = up[c]
            return c

        found, held = [], [k for k, s in enumerate(seeks) if not s]
        for x in (k for k, s in enumerate(seeks) if s):
            for y in held:
                # two outsiders meet twice: once is enough
                if (not out[y] or nodes[x] < nodes[y]) and (p := root(comp[x])) != (q := root(comp[y])) and probability_jaccard(*got[x], *got[y]) >= threshold:
                    up[max(p, q)] = min(p, q)
                    found.append((nodes[x], nodes[y]))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return full.groupBy("key", "i", "j").applyInArrow(run, "a long, b long")


def classed(docs: DataFrame, size: int = 5, threshold: float = 0.8, bands: int = 21, rows: int = 6, block: int = 256) -> DataFrame:
    """doc_id, row, digest, class_id and kept of each row; see `near_documents`.
    `kept` marks the row that stands for its class: its smallest doc_id and, of
    several texts of that id, the smallest digest. Digest is null for a text
    without words, which stands for itself."""
    texts = keyed(docs)
    signed = stored(signatures(texts, size, bands, rows), "signatures")
    first = F.coalesce(F.min_by("row", "doc_id"), F.min("row"))
    reps = signed.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("id"), first.alias("row"), F.first("keys").alias("keys"))
    # numbers of a stored table: unlike a 64-bit digest they are never shared
    reps = stored(reps.withColumn("node", F.monotonically_increasing_id()), "classes")
    banded = reps.select("node", F.explode("keys").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("n")).filter("n > 1").select("key", "head")
    shared = stored(banded.join(buckets, "key"), "buckets")
    wanted = reps.select("digest", "row", "node").join(shared.select("node").distinct(), "node", "left_semi")
    sets = weighted(texts, size, Members(wanted, "row")).join(wanted.select("digest", "node"), "digest").dropDuplicates(["digest"]).drop("digest")
    sets = stored(sets, "shingles")
    star = shared.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    links = cut(verified(star, sets, threshold))
    parts = cut(connected_components(links))
    more = across(shared.select("key", "node"), parts, sets, threshold, block)
    parts = connected_components(links.union(more))
    nodes = stored(reps.select("digest", "id", "node").join(parts, "node", "left").select("digest", "id", F.coalesce("component", "node").alias("component")), "components")
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "digest")))
    named = nodes.groupBy("component").agg(least.alias("least")).select("component", "least.id", F.col("least.digest").alias("stands"))
    # an id that repeats may be the smallest of several classes: one of them is called by it
    twice = named.groupBy("id").agg(F.min("stands").alias("by"), F.count("*").alias("n")).filter("id IS NOT NULL AND n > 1").select("id", "by")
    name = F.when(F.col("by").isNull() | (F.col("by") == F.col("stands")), F.col("id")).otherwise(F.xxhash64("stands"))
    named = named.join(twice, "id", "left").select("component", F.col("id").alias("least"), "stands", name.alias("class_id"))
    of = nodes.select("digest", "component").join(named, "component").drop("component")
    kept = F.when(F.col("digest").isNull(), F.col("doc_id").isNotNull()).otherwise((F.col("doc_id") == F.col("least")) & (F.col("digest") == F.col("stands")))
    joined = signed.select("doc_id", "row", "digest").join(of, "digest", "left")
    return joined.select("doc_id", "row", "digest", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce(kept, F.lit(False)).alias("kept"))


def near_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id and class_id of each row; class_id is the smallest doc_id linked to
    its text, itself included.

    Texts link if their `size`-word shingles, weighted by how often they occur,
    have a probability Jaccard of at least `threshold`. Equal texts are one
    class from the start. Texts that share a band key are candidates; a pair at
    0.8 meets with probability 0.998 under the default bands. Each member of a
    bucket is first checked against one of it; components follow; then members
    outside a bucket's largest component are checked against all its members
    that are in another, in blocks. Pairs inside a component need no check, so a
    group of thousands of near copies costs about one check a member, and no
    link is left out.

    Texts that are null, empty or without words are in a class of their own. A
    null doc_id gets the class of its text, and a class without any id the null
    one. Rows that repeat a doc_id are classed by their own text; if an id is
    the smallest of several classes, that of the smallest digest is called by
    it and the others by a hash of theirs. Extra columns are ignored; an empty
    table gives no rows."""
    return classed(docs, **options).select("doc_id", "class_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stand for their class, once each. Rows without a
    doc_id cannot be told apart and stay.

    A filter of fixed size holds the rows that go or repeat; rows that it
    rejects stay where they are, and only the others are joined."""
    classes = stored(classed(docs, **options), "near").filter("doc_id IS NOT NULL")
    fate = classes.groupBy("row", "digest").agg(F.max("kept").alias("__near_kept"), F.count("*").alias("_n")).filter("NOT __near_kept OR (_n > 1 AND digest IS NOT NULL)")
    fate = stored(fate.select(F.col("row").alias("__near_row"), F.coalesce("digest", F.lit(b"")).alias("__near_digest"), "__near_kept"), "fate")
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    rows = docs.withColumn("__near_digest", digest).withColumn("__near_row", F.xxhash64(F.col("doc_id").cast("long"), F.col("__near_digest")))
    some = Members(fate, "__near_row").column("__near_row")
    sure = rows.filter(~some)
    asked = rows.filter(some).join(fate, ["__near_row", "__near_digest"], "left")
    asked = asked.filter("__near_kept IS NULL").unionByName(asked.filter("__near_kept").dropDuplicates(["__near_row", "__near_digest"]))
    return sure.unionByName(asked.drop("__near_kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
