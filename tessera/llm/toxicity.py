"""Toxic spans by a linear-chain conditional random field."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import cut, small_slices, stored

FEATURES = 1 << 17
#: Parameters of the chain: features, transitions and start.
SIZE = FEATURES + 6
#: Features of a token at most.
WIDTH = 7
SEGMENT = 64
CACHE = 60_000
#: Tokens whose features are worked out at once.
TOKENS = 1 << 14
#: Rows and bytes of text whose marginals are worked out at once.
SLICE = 128, 1 << 20
EDGE = re.compile(r"^\W+|\W+$")
TOKEN = re.compile(r"\S+")


def word_features(token: str) -> list[str]:
    """What the field sees of a token: its word, beginnings, ending and shape."""
    w = EDGE.sub("", token.lower())
    out = [f"p{k}:{w[:k]}" for k in (3, 4, 5, 6) if len(w) >= k]
    return [f"w:{w}", *out, f"s:{w[-3:]}", f"f:{len(token) != len(w)}{token[:1].isupper()}{min(len(w), 12)}"]


def feature_ids(token: str) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % FEATURES for f in word_features(token)]


#: Crc of the mark in front of a feature's text.
MARKS = {m: zlib.crc32(m.encode()) for m in ("w:", "p3:", "p4:", "p5:", "p6:", "s:")}
SHAPES = np.array([zlib.crc32(f"f:{edge}{upper}{n}".encode()) for edge in (False, True) for upper in (False, True) for n in range(13)], "int64")
#: Crc of each byte behind a state of none: a step of a crc is a look into it.
STEPS = np.array([zlib.crc32(bytes([k]), 0xFFFFFFFF) ^ 0xFFFFFFFF for k in range(256)], "uint32")


def crcs(raw: np.ndarray, start: np.ndarray, end: np.ndarray, before: int) -> np.ndarray:
    """Crc32 of each raw[start:end], as carried on from `before`."""
    state, left = np.full(len(start), before ^ 0xFFFFFFFF, "uint32"), end - start
    for k in range(int(left.max(initial=0))):
        own = slice(None) if (left > k).all() else np.flatnonzero(left > k)
        now = state[own]
        state[own] = STEPS[(now ^ raw[start[own] + k]) & 0xFF] ^ (now >> 8)
    return (state ^ np.uint32(0xFFFFFFFF)).astype("int64")


def feature_table(tokens: list[str]) -> np.ndarray:
    """`feature_ids` of many tokens, a row each; -1: the word is too short for a
    beginning. Beginnings and endings are a few bytes of one text of all words, so
    their crcs are worked out for all words at once."""
    words = [t.lower() for t in tokens]
    words = [w if w[0].isalnum() and w[-1].isalnum() else EDGE.sub("", w) for w in words]
    coded = [w.encode("utf-8", "surrogatepass") for w in words]
    size = np.fromiter(map(len, words), "int64", len(words))
    raw = np.frombuffer(b"".join(coded), "uint8")
    # place of each character's first byte, so that beginnings are of characters
    at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    head = np.cumsum(size) - size
    out = np.full((len(words), WIDTH), -1, "int64")
    out[:, 0] = np.fromiter((zlib.crc32(w, MARKS["w:"]) for w in coded), "int64", len(words))
    for k in (3, 4, 5, 6):
        rows = np.flatnonzero(size >= k)
        out[rows, k - 2] = crcs(raw, at[head[rows]], at[head[rows] + k], MARKS[f"p{k}:"])
    out[:, 5] = crcs(raw, at[head + np.maximum(size - 3, 0)], at[head + size], MARKS["s:"])
    edge, upper = np.fromiter(map(len, tokens), "int64", len(tokens)) != size, np.fromiter((t[0].isupper() for t in tokens), "bool", len(tokens))
    out[:, 6] = SHAPES[(2 * edge + upper) * 13 + np.minimum(size, 12)]
    return np.where(out < 0, -1, out % FEATURES)


def messages(score: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages of chains laid end to end, one chain a text
    however long, each as the odds of state 1 to state 0. `score`: log odds that
    each token's own features give to state 1. Their product is the odds of the
    token's marginal.

    A step of a message is a fraction of two linear terms, so a run of steps is
    one too. Rows of SEGMENT tokens are first made one step each, messages are
    carried from row to row of a text, then through all rows at once. Nothing
    stands behind a text's last token."""
    (t00, t01), (t10, t11) = np.exp(trans)
    rows = -(-lengths // SEGMENT)
    starts, n = np.cumsum(rows) - rows, int(rows.sum())
    at = np.repeat(starts * SEGMENT - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(score))
    place, row = at % SEGMENT, at // SEGMENT
    e = np.ones((SEGMENT, n))
    e[place, row] = np.exp(np.clip(score, -30, 30))
    used = np.bincount(row, minlength=n)
    head = np.zeros(n, "bool")
    head[starts[rows > 0]] = True
    begin = np.exp(start[1] - start[0])

    into, behind = np.zeros(n), np.ones(n)  # odds before a row's first and behind its last token
    long = np.flatnonzero(np.repeat(rows > 1, rows))
    if len(long):
        first, end = head[long], used[long]
        a, b, c, d = (np.where(first, x, y) for x, y in ((0, t11 * e[0, long]), (begin * e[0, long], t01 * e[0, long]), (0, t10), (1, t00)))
        for k in range(1, SEGMENT):
            own = e[k, long]
            step = own * (t11 * a + t01 * c), own * (t11 * b + t01 * d), t10 * a + t00 * c, t10 * b + t00 * d
            size = step[2] + step[3]
            if k >= end.min():
                a, b, c, d = (np.where(k < end, x / size, y) for x, y in zip(step, (a, b, c, d)))
            else:
                a, b, c, d = (x / size for x in step)
        steps = np.zeros((4, n))
        steps[:, long] = a, b, c, d
        for j in range(1, int(rows.max())):
            r = starts[rows > j] + j
            a, b, c, d = steps[:, r - 1]
            into[r] = (a * into[r - 1] + b) / (c * into[r - 1] + d)
            r = starts[rows > j] + rows[rows > j] - j
            a, b, c, d = steps[:, r]
            behind[r - 1] = (a * behind[r] + c) / (b * behind[r] + d)

    forward, backward = np.empty((SEGMENT, n)), np.empty((SEGMENT, n))
    odds = np.where(head, begin, (t01 + t11 * into) / (t00 + t10 * into)) * e[0]
    forward[0] = odds
    for k in range(1, SEGMENT):
        odds = e[k] * (t01 + t11 * odds) / (t00 + t10 * odds)
        forward[k] = odds
    odds = behind
    backward[-1] = odds
    for k in range(SEGMENT - 2, -1, -1):
        next_ = e[k + 1] * odds
        odds = np.where(k >= used - 1, behind, (t10 + t11 * next_) / (t00 + t01 * next_))
        backward[k] = odds
    return forward[place, row], backward[place, row]


def forward_backward(score, trans: np.ndarray, start: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Of chains of any lengths: the marginals of state 1 of each, and the sum
    over all neighbours of the pairwise marginals."""
    lengths = np.array([len(x) for x in score], "int64")
    flat = np.concatenate([*score, np.empty(0)])
    f, b = messages(flat, lengths, trans, start)
    odds, pairs = f * b, np.zeros((2, 2))
    inside = np.ones(len(flat), "bool")
    inside[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    k = np.flatnonzero(inside)
    if len(k):
        t, left, right = np.exp(trans), f[k - 1], np.exp(np.clip(flat[k], -30, 30)) * b[k]
        joint = np.array([[t[0, 0] + 0 * left, t[0, 1] * right], [t[1, 0] * left, t[1, 1] * left * right]])
        pairs = (joint / joint.sum(axis=(0, 1))).sum(axis=2)
    return np.split(odds / (1 + odds), np.cumsum(lengths)[:-1]), pairs


class Field:
    """Weights of the chain, and of the document score over its marginals. A
    copy starts with no token scores: tasks score with a copy, so that a worker
    that goes on to another stage does not keep them."""

    def __init__(self, flat: np.ndarray | None = None):
        flat = np.zeros(SIZE, "float32") if flat is None else flat
        self.weights, self.trans, self.start = flat[:FEATURES], flat[FEATURES : FEATURES + 4].reshape(2, 2).astype("float64"), flat[FEATURES + 4 :].astype("float64")
        self.document = np.zeros(4)
        self._scores: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"_scores": {}}

    def know(self, tokens: set[str]) -> None:
        """Have the scores of `tokens` at hand."""
        known = self._scores
        new = tokens.difference(known)
        if len(known) + len(new) > CACHE:
            known.clear()
            new = tokens
        new = list(new)
        for at in range(0, len(new), TOKENS):
            part = new[at : at + TOKENS]
            ids = feature_table(part)
            known.update(zip(part, np.where(ids < 0, np.float32(0), self.weights[ids]).sum(axis=1).tolist()))

    def token_scores(self, tokens: list[str]) -> np.ndarray:
        if any(t not in self._scores for t in tokens):
            self.know(set(tokens))
        return np.fromiter(map(self._scores.__getitem__, tokens), "float64", len(tokens))

    def marginals(self, texts: list[str]) -> list[np.ndarray]:
        """Of each whole text, P(toxic) of each token."""
        tokens = [t.split() for t in texts]
        self.know(set().union(*tokens))
        return forward_backward([np.fromiter(map(self._scores.__getitem__, t), "float64", len(t)) for t in tokens], self.trans, self.start)[0]

    def document_features(self, marginals: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(marginals), 4))
        out[:, 0] = 1
        for i, p in enumerate(marginals):
            if len(p):
                out[i, 1:] = p.max(), np.log1p(p[p > 0.01].sum()), min(1.0, 20 * p[p > 0.01].sum() / len(p))
        return out

    def document_scores(self, marginals: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.document_features(marginals) @ self.document, -35, 35)))


def token_labels(sample: DataFrame, classes: dict[int, int], odds: float = 20.0, least: int = 5) -> frozenset:
    """Labelled tokens from labelled documents: a word, or beginning of a word,
    is toxic if the share of toxic documents that hold it is `odds` times that
    of the others, and at least `least` do. Counted in Spark."""

    def run(batches):
        for b in small_slices(batches, 512):
            seen = (Counter(), Counter())
            for text, y in zip(b["text"].to_pylist(), b["toxic"].to_pylist()):
                seen[y].update({f for w in set(text.split()) for f in word_features(w) if f[0] in "wp" and f[1] != "3" and len(f) > 4})
            found = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *[pa.array([seen[y][f] for f in found], pa.int64()) for y in (1, 0)]], ["feature", "toxic", "clean"])

    counts = sample.select("text", "toxic").mapInArrow(run, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share = (F.col("toxic") / max(1, classes.get(1, 0))) / ((F.col("clean") + 0.5) / max(1, classes.get(0, 0)))
    return frozenset(r[0] for r in counts.filter((F.col("toxic") >= least) & (share >= odds)).select("feature").collect())


SHARD = "shard int, ids binary, lengths binary, toxic binary, features binary, marked binary"


def prepared(sample: DataFrame, marks: frozenset) -> DataFrame:
    """One row a shard: its texts as numbers of words, their lengths and labels,
    and of each word its features (-1: none) and whether it is labelled."""

    def run(key, t):
        t, words, docs = t.sort_by("doc_id"), {}, []
        for text in t["text"].to_pylist():
            docs.append(np.array([words.setdefault(w, len(words)) for w in text.split()], "int32"))
        ids = np.full((len(words), WIDTH), -1, "int32")
        for row, w in zip(ids, words):
            own = feature_ids(w)
            row[: len(own)] = own
        marked = np.array([any(f in marks for f in word_features(w)) for w in words], "bool")
        lengths = np.array([len(d) for d in docs], "int32")
        cols = np.concatenate([*docs, np.empty(0, "int32")]), lengths, t["toxic"].to_numpy().astype("int32"), ids, marked
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32())} | {n: pa.array([c.tobytes()]) for n, c in zip(("ids", "lengths", "toxic", "features", "marked"), cols)})

    return sample.groupBy("shard").applyInArrow(run, SHARD)


def learn(shard: dict, flat: np.ndarray, past: np.ndarray, seed: int, rate: float = 0.4, l2: float = 1e-4, group: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """One pass of adaptive gradient steps over whole texts (a row of
    `prepared`), `group` texts a step, from parameters `flat` and sums of
    squared gradients `past`."""
    ids, lengths, toxic = (np.frombuffer(shard[c], "int32") for c in ("ids", "lengths", "toxic"))
    features, marked = np.frombuffer(shard["features"], "int32").reshape(-1, WIDTH), np.frombuffer(shard["marked"], "bool")
    docs = np.split(ids, np.cumsum(lengths)[:-1])
    # a toxic text without a labelled token says nothing of where it is toxic
    use = [i for i, d in enumerate(docs) if len(d) and (not toxic[i] or marked[d].any())]
    use = [use[i] for i in np.random.default_rng(seed).permutation(len(use))]
    flat, past = flat.astype("float64"), past.astype("float64")
    for at in range(0, len(use), group):
        part = use[at : at + group]
        lengths = np.array([len(docs[i]) for i in part])
        own, where = np.unique(np.concatenate([docs[i] for i in part]), return_inverse=True)
        f = features[own]
        valid = f >= 0
        score = np.where(valid, flat[f], 0).sum(axis=1)[where]
        y = (marked[own][where] & np.repeat(toxic[part] == 1, lengths)).astype("int64")
        cuts = np.cumsum(lengths)
        chain = flat[FEATURES : FEATURES + 4].reshape(2, 2), flat[FEATURES + 4 :]
        p, pairs = forward_backward(np.split(score, cuts[:-1]), *chain)
        p, size = np.concatenate(p), len(y) / 32
        off = np.bincount(where, p - y, len(own))
        grad = np.zeros(SIZE)
        grad[:FEATURES] = np.bincount(f[valid], np.broadcast_to(off[:, None], f.shape)[valid], FEATURES)
        heads = cuts - lengths
        before, after = np.delete(y, cuts - 1), np.delete(y, heads)
        seen = np.array([[((before == i) & (after == j)).sum() for j in (0, 1)] for i in (0, 1)])
        grad[FEATURES : FEATURES + 4] = (pairs - seen).ravel()
        grad[FEATURES + 4 :] = np.array([-1, 1]) * (p[heads] - y[heads]).sum()
        grad = grad / size
        grad[:FEATURES] += l2 * flat[:FEATURES]
        past += grad * grad
        flat -= rate * grad / np.sqrt(past)
    return flat.astype("float32"), past.astype("float32")


def document_weights(x: np.ndarray, toxic: np.ndarray, prior: float) -> np.ndarray:
    """Ridge logistic regression by Newton steps, classes weighted to `prior`."""
    w, ridge = np.zeros(x.shape[1]), np.array([1e-5, *[0.2] * (x.shape[1] - 1)])
    share, prior = (min(max(float(v), 1e-3), 1 - 1e-3) for v in (np.mean(toxic), prior))
    weight = np.where(toxic == 1, prior / share, (1 - prior) / (1 - share))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        w -= np.linalg.solve(hess, x.T @ (weight * (p - toxic)) + ridge * w)
    return w


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves no rest divided by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000, shards: int = 8, epochs: int = 10, seed: int = 3) -> Field:
    """Fit on at most `per_class` labelled documents of each class (the bounded
    sample), whole texts, none of them held out. Labels without a document, and
    null labels, are left out; of several labels of a document the largest
    counts, and of several texts the smallest.

    The sample stays in Spark, dealt into `shards` by id. In each epoch every
    shard takes gradient steps from the shared parameters in a task of its own,
    and the mean of the shards' parameters is shared next: the driver holds
    parameters, the words labelled toxic and four numbers a sampled document."""
    spark = docs.sparkSession
    marked = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("_toxic"))
    counts = dict(marked.groupBy("_toxic").count().collect())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = marked.filter("_toxic = 1").orderBy(*order).limit(per_class).union(marked.filter("_toxic = 0").orderBy(*order).limit(per_class))
    ids = spark.createDataFrame(some.collect(), "doc_id long, toxic int")  # at most 2 * per_class rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    sample = stored(texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")), "sample")
    classes = dict(sample.groupBy("toxic").count().collect())
    if not classes:
        return Field()
    shard_rows = cut(prepared(sample, token_labels(sample, classes)).repartitionByRange(shards, "shard"))
    flat, past = np.zeros(SIZE, "float32"), np.full(SIZE, 1e-6, "float32")

    def pass_over(now, epoch):
        shared = spark.sparkContext.broadcast(now)

        def run(batches):
            for row in (r for b in batches for r in b.to_pylist()):
                found = learn(row, *shared.value, seed + epoch)
                yield pa.RecordBatch.from_arrays([pa.array([row["shard"]], pa.int32()), *[pa.array([x.tobytes()]) for x in found]], ["shard", "flat", "past"])

        found = sorted(shard_rows.mapInArrow(run, "shard int, flat binary, past binary").collect())
        shared.destroy()
        return [np.mean([np.frombuffer(r[i], "float32") for r in found], axis=0, dtype="float64").astype("float32") for i in (1, 2)]

    for epoch in range(epochs):
        flat, past = pass_over((flat, past), epoch)
    field = Field(flat)
    shared = spark.sparkContext.broadcast(field)

    def features(batches):
        model = copy(shared.value)
        for b in small_slices(batches, *SLICE):
            x = model.document_features(model.marginals(b["text"].to_pylist()))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["toxic"], pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "toxic", "x"])

    rows = sorted(sample.select("doc_id", "toxic", "text").mapInArrow(features, "doc_id long, toxic int, x array<double>").collect())
    field.document = document_weights(np.array([r[2] for r in rows]), np.array([r[1] for r in rows]), counts.get(1, 0) / sum(counts.values()))
    return field


def score(docs: DataFrame, field: Field, spans: bool = True) -> DataFrame:
    """doc_id, score, predicted and spans (start, end of each run of tokens with
    P(toxic) >= 0.5, in code points of the text) of each row, whole texts.

    Only the text is read: not lang, source or labels. Null text counts as
    empty; empty texts get the score of no evidence. Rows that repeat are each
    scored alike; a null doc_id is kept; an empty table gives none."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def found(text: str, p: np.ndarray) -> list[dict]:
        if not spans or not len(p) or p.max() < 0.5:
            return []
        out, open_ = [], False
        for m, hot in zip(TOKEN.finditer(text), (p >= 0.5).tolist()):
            if hot and open_:
                out[-1]["end"] = m.end()
            elif hot:
                out.append({"start": m.start(), "end": m.end()})
            open_ = hot
        return out

    def run(batches):
        model = copy(shared.value)
        for b in small_slices(batches, *SLICE):
            texts = b["text"].to_pylist()
            marg = model.marginals(texts)
            s, where = model.document_scores(marg), [found(t, p) for t, p in zip(texts, marg)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(s), pa.array((s >= 0.5).astype("int32")), pa.array(where, kind)], ["doc_id", "score", "predicted", "spans"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(run, "doc_id long, score double, predicted int, spans array<struct<start:int,end:int>>")


def without_toxic(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of `docs` that `field` does not predict toxic, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.arrow_udf("boolean")
    def toxic(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = copy(shared.value)
        for texts in batches:
            out = [np.empty(0, "bool")]
            for part in small_slices([pa.RecordBatch.from_arrays([texts], ["text"])], *SLICE):
                marg = model.marginals([t or "" for t in part["text"].to_pylist()])
                out.append(model.document_scores(marg) >= 0.5)
            yield pa.array(np.concatenate(out))

    return docs.filter(~toxic(F.col("text")))


def clean_documents(docs: DataFrame, labels: DataFrame, per_class: int = 3000) -> DataFrame:
    """The rows of `docs` that a field trained on `labels` does not predict toxic."""
    return without_toxic(docs, train(docs, labels, per_class))
