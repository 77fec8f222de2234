"""Resampling, decontamination and the filter audit against brute force."""

import hashlib
import math
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontaminate, filter_audit, resample

DOCS = "doc_id long, text string, lang string, source string, row long, part string, words string, window int, pos long, score long, good int, toxic int, digest string, hash string, start int"
EXTRA = ("s", 1, "p", "w", 1, 1, 1, 0, 0, "d", "h", 1)


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], DOCS)


def corpus(seed, n=160):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(60)] + ["Ärger", "éTé", "ÉTÉ", "日本", "Don't", "A-b", "x$y"]
    rows = [(i, " ".join(rng.choices(names, k=rng.choice([0, 1, 5, 19, 20, 60, 150]))), rng.choice(["en", "de", "", None])) for i in range(n)]
    rows += [(n + k, rows[5][1], "en") for k in range(30)] + [(7, rows[7][1], "fr"), (7, "UPPER CASE TEXT & MORE", "fr"), (None, rows[5][1], "en"), (None, None, None), (5000, None, "en"), (5001, "", "xx"), (5002, " \t\n", "en")]
    rows += [(6000, "word " * 30_000 + "Q" * 90_000, "en"), (-3, rows[9][1], "de"), (1 << 40, " ".join(names), "en")]
    rng.shuffle(rows)
    return rows


# ---- sorted lists


def test_posting_lists_equal_sets():
    rng = random.Random(1)
    for _ in range(300):
        lists = [sorted(rng.sample(range(rng.choice([5, 50, 400])), rng.randint(0, 5))) if rng.random() < 0.5 else sorted({rng.randrange(400) for _ in range(rng.randint(0, 300))}) for _ in range(rng.randint(0, 5))]
        every = filter_audit.union(lists)
        assert every == sorted(set().union(*lists))
        for ids in lists:
            other = rng.choice(lists)
            assert filter_audit.difference(ids, other) == sorted(set(ids) - set(other))
            assert filter_audit.common(ids, other) == len(set(ids) & set(other))
            x = rng.randrange(-1, 401)
            assert filter_audit.gallop(ids, x, 0) == bisect_left(ids, x)


def brute_audit(rows, labels):
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1 and i is not None} for k in (0, 1))
    fails = []
    for i, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = {f for f, x in zip("ABCDE", (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search("[#$%&*|]", text)), i is not None and i > first[text])) if x}
        fails.append((lang or "", bad, i in good, i in toxic))
    out = {}
    for part in {f[0] for f in fails}:
        own = [f for f in fails if f[0] == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            for s, x in enumerate(order):
                before = set(order[:s])
                here = [f for f in own if x in f[1] and not f[1] & before]
                shapley[x] += len(here)
                out[part, order, s + 1] = [sum(not f[1] & set(order[: s + 1]) for f in own), len(here), sum(x in f[1] for f in own) - len(here), sum(f[1] == {x} for f in own), sum(f[2] for f in here), sum(f[3] for f in here), x]
        for key in out:
            if key[0] == part:
                out[key][-1] = shapley[out[key][-1]]
    return sorted((*k, *v) for k, v in out.items())


@pytest.mark.parametrize("bits, hot", [(13, 10_000), (2, 10)])
def test_audit_equals_brute_force(spark, monkeypatch, bits, hot):
    monkeypatch.setattr(filter_audit, "RANGE_BITS", bits)
    monkeypatch.setattr(filter_audit, "HOT", hot)
    rows = corpus(2)
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 200, 3)] + [(3, None, 1), (3, 1, None), (None, 1, 1), (6000, 1, 1)]
    got = filter_audit.audit_texts(frame(spark, rows).repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns[:3] == ["part", "filter_order", "step"]
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows, labels)


def test_audit_of_other_filters(spark):
    rows = spark.createDataFrame([("p", k, k % 2 == 0, k % 3 == 0, k == 6, False) for k in range(12)], "part string, row long, X boolean, Y boolean, good boolean, toxic boolean")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.shapley) for r in filter_audit.audit(rows, "XY").collect()}
    assert got == {("XY", 1): (6, 6, 0, 4, 1, 10), ("XY", 2): (4, 2, 2, 2, 0, 6), ("YX", 1): (8, 4, 0, 2, 1, 6), ("YX", 2): (4, 4, 2, 4, 0, 10)}


# ---- resampling


def brute_resample(rows, target, percent=10, least=20, buckets=10_000, most=1):
    def features(text):
        w = split(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, most + 1) for i in range(len(w) - n + 1)]

    s, t = (Counter(f for x in xs for f in features(x)) for xs in ([r[1] for r in rows], target))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out = []
    for i, text, _ in rows:
        f = features(text)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f)) // len(f) if f else 0
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(split(text)) >= least])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("chunk, digit, percent, most", [(1 << 14, 12, 10, 1), (7, 3, 100, 2)])
def test_resample_equals_brute_force(spark, monkeypatch, chunk, digit, percent, most):
    monkeypatch.setattr(resample, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(resample, "DIGIT_BITS", digit)
    rows = corpus(3)
    target = [" ".join(f"w{k % 9}" for k in range(40)), None, "", "Ärger AND 日本"]
    if percent == 100:  # halves of ids of either sign
        rows += [(-(1 << 62) - k, rows[12][1], "en") for k in range(3)] + [((1 << 62) + k, rows[12][1], "en") for k in range(3)]
    items = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = resample.resample(frame(spark, rows).repartition(3), items, percent=percent, most=most)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_resample(rows, target, percent, most=most)


def test_resample_of_ties_and_none(spark):
    same = [(4, "x " * 25, "en")] * 3 + [(4, "x " * 30, "en")] * 2
    items = spark.createDataFrame([], "item_id long, text string")
    got = resample.resample(frame(spark, same), items, percent=100)
    assert sorted((r["rank"], r.n_features) for r in got.collect()) == [(1, 25), (2, 25), (3, 25), (4, 30), (5, 30)]
    assert resample.resample(frame(spark, same).limit(0), items).count() == 0
    assert [r["rank"] for r in resample.resample(frame(spark, [(1, None, None)]), items).collect()] == [None]


# ---- decontamination


def brute_hits(rows, items, window=10):
    wins = {}
    for i, text in items:
        w = split(text)
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            wins.setdefault(tuple(w[a : a + k]), set()).add(i)
    out = []
    for i, text, _ in rows:
        w, hit, names = split(text), set(), set()
        for k in {len(x) for x in wins}:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in wins:
                    hit |= set(range(a, a + k))
                    names |= {str(x) for x in wins[tuple(w[a : a + k])] if x is not None}
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 18, 5])
def test_decontamination_equals_brute_force(spark, block):
    rng = random.Random(5)
    rows = [r for r in corpus(4, 80) if r[0] != 6000] + [(6000, "word " * 3000, "en"), (6001, "w1 " * 40, "en")]
    words = [split(t) for _, t, _ in rows if len(split(t)) > 30]
    items = [(k, " ".join(w[a : a + rng.choice([10, 11, 25])])) for k, w in enumerate(rng.choices(words, k=12)) for a in [rng.randrange(15)]]
    items += [(100, "w1, W2."), (101, "W3"), (102, "Don't a-B x"), (103, None), (104, ""), (None, "w4 w5"), (105, "w7 w7 w7 w7 w7 w7 w7"), (3, "w1 " * 15), (106, "word " * 12), (107, items[0][1]), (108, "nowhere at all to be found in any of the documents here"), (109, "ÉTÉ w1"), (110, "été w1")]
    rows += [(7000 + k, "Before it " + items[k % 12][1].upper().replace(" ", " - ") + "; after", "en") for k in range(20)]  # É stays É
    own = spark.createDataFrame([(i, t, "k", 1, "w") for i, t in items], "item_id long, text string, hash string, row int, words string")
    got = decontaminate.contaminated(frame(spark, rows).repartition(4), own, block=block)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_hits(rows, items)
    plan = got._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_decontamination_without_rows(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = frame(spark, [(1, "x a b c y", "en"), (2, None, "en")])
    assert [(r.n_hit, r.n_items) for r in decontaminate.contaminated(docs, items).orderBy("doc_id").collect()] == [(3, 1), (0, 0)]
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    none = decontaminate.contaminated(docs, items.filter("item_id > 1"))
    assert none.filter("n_hit = 0 AND NOT contaminated").count() == 2 and none.select(F.max("n_words")).first()[0] == 5
