import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tessera.llm import html_extract, lm_score, minhash, toxicity


# ---- MinHash

def jp(a, b):
    """Probability Jaccard by its definition."""
    wa, wb = sum(a.values()), sum(b.values())
    out = 0.0
    for i in a.keys() & b.keys():
        out += 1 / sum(max(a.get(j, 0) / wa / (a[i] / wa), b.get(j, 0) / wb / (b[i] / wb)) for j in a.keys() | b.keys())
    return out


def grams(text):
    w = text.lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_exact_similarity_and_estimate():
    rng = random.Random(4)
    for _ in range(40):
        a = Counter(rng.choices(range(30), k=60))
        b = Counter(rng.choices(range(10, 45), k=50))
        h = [np.array(sorted(x), "uint64") for x in (a, b)]
        w = [np.array([x[k] for k in sorted(x)]) for x in (a, b)]
        assert minhash.probability_jaccard(h[0], w[0], h[1], w[1]) == pytest.approx(jp(a, b))
    h = [minhash.mixed(x) for x in h]
    s = [minhash.prob_minhash(x, y, 4096) for x, y in zip(h, w)]
    assert abs((s[0] == s[1]).mean() - jp(a, b)) < 0.04
    scaled = minhash.prob_minhash(h[0], 3 * w[0], 4096)  # only proportions count
    assert (scaled == s[0]).mean() > 0.999
    for n in (1, 126, 2049, 20_000):
        assert len(minhash.prob_minhash(h[0], w[0], n)) == n
    with pytest.raises(ValueError):
        minhash.prob_minhash(h[0], w[0], (1 << 24) + 1)


def corpus():
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    base = [[word() for _ in range(rng.choice([3, 8, 60, 200]))] for _ in range(40)]
    rows = []
    for i, b in enumerate(base):
        for k in range(rng.choice([1, 1, 3, 6])):
            w = list(b)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 12]) if len(w) > 20 else 0):
                w[rng.randrange(len(w))] = word()
            rows.append((len(rows) * 3, " ".join(w)))
    hot = [word() for _ in range(150)]
    for k in range(120):  # a large group of near copies
        w = list(hot)
        w[k] = word()
        rows.append((5000 + k, " ".join(w)))
    shared = " ".join(word() for _ in range(80))
    rows += [(7000 + k, shared + " " + " ".join(word() for _ in range(60))) for k in range(60)]  # one long passage
    rows += [(8000 + k, base[5] and " ".join(base[5])) for k in range(50)]
    rows += [(9000, None), (9001, ""), (9002, " \n "), (9003, rows[0][1].upper()), (9004, "one"), (9005, "one")]
    rng.shuffle(rows)
    return rows


def test_classes_equal_brute_force(spark):
    rows = corpus()
    up = {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    sets = {i: grams(t or "") for i, t in rows}
    ids = [i for i in sets if sets[i]]
    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            if a.keys() & b.keys() and 2 * min(len(a), len(b)) > max(len(a), len(b)) and jp_fast(a, b) >= 0.8:
                p, q = root(ids[x]), root(ids[y])
                up[max(p, q)] = min(p, q)
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, key int, class_id string")
    got = dict(minhash.near_documents(df, block=16).collect())
    wrong = [i for i in up if got[i] != root(i)]
    assert len(got) == len(rows) and not wrong
    kept = [r.doc_id for r in minhash.keep_one(df).collect()]
    assert sorted(kept) == sorted({root(i) for i in up})
    assert minhash.near_documents(df.limit(0)).count() == 0


def jp_fast(a, b):
    keys = {k: n for n, k in enumerate(a.keys() | b.keys())}
    h = [np.array(sorted(keys[k] for k in x), "uint64") for x in (a, b)]
    back = {n: k for k, n in keys.items()}
    return minhash.probability_jaccard(h[0], np.array([a[back[int(n)]] for n in h[0]]), h[1], np.array([b[back[int(n)]] for n in h[1]]))


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, "q")], "doc_id long, text string")
    assert sorted(map(str, (tuple(r) for r in minhash.near_documents(df).collect()))) == sorted(map(str, [(1, 1), (1, 1), (2, 1), (None, 1), (None, None)]))
    assert sorted(map(str, (r.doc_id for r in minhash.keep_one(df).collect()))) == ["1", "None", "None"]


def test_repeated_ids_of_unlike_texts(spark):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six"
    df = spark.createDataFrame([(5, a), (5, b), (7, b), (8, a), (5, a)], "doc_id long, text string")
    got = minhash.classed(df).collect()
    assert len({r.class_id for r in got}) == 2 and all(len({r.class_id for r in got if r.digest == d}) == 1 for d in {r.digest for r in got})
    assert sorted((r.doc_id, r.text) for r in minhash.keep_one(df).collect()) == [(5, a), (5, b)]


def test_null_ids_link_and_outsiders_meet_all(spark):
    rng = random.Random(11)
    words = [str(rng.random()) for _ in range(120)]
    rows = [(None if k < 3 else k, " ".join([*words[:k], "new", *words[k + 1 :]])) for k in range(0, 60, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.class_id for r in minhash.near_documents(df, block=4).collect()} == {4}


def test_filter_holds_all_members(spark):
    from pyspark.sql import functions as F
    from tessera.llm.common import Members

    rows = spark.range(20_000).select(F.xxhash64("id").alias("h"), "id")
    kept = Members(rows.filter("id < 5000"), "h").column("h")
    found = [r.id for r in rows.filter(kept).collect()]
    assert set(range(5000)) <= set(found) and len(found) < 5300
    assert rows.filter(Members(rows.limit(0), "h").column("h")).count() == 0


# ---- language models

def test_losses_by_hand(spark):
    texts = {1: "a b a b", 2: "a b c", 3: None, 4: "c c zz9 ###"}
    df = spark.createDataFrame([(i, t, 1.0) for i, t in texts.items()], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (1, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in lm_score.cross_entropy_difference(df, labels).collect()}
    assert got[3].n_tokens == 0 and got[3].score is None

    def loss(train, text, d=0.75):
        v = lm_score.VOCABULARY
        bi, ctx = Counter(), Counter()
        uni = Counter()
        for t in train:
            w = ["<s>", *t.split()]
            bi.update(zip(w, w[1:]))
            ctx.update(w[:-1])
            uni.update(w[1:])
        n, w = sum(uni.values()) + v, ["<s>", *text.split()]
        out = 0.0
        for a, b in zip(w, w[1:]):
            kinds = sum(1 for x in bi if x[0] == a)
            rest = d * kinds / ctx[a] if ctx[a] else 1.0
            out -= math.log((max(bi[a, b] - d, 0) / ctx[a] if ctx[a] else 0) + rest * (uni[b] + 1) / n)
        return out / (len(w) - 1)

    every = [t for t in texts.values() if t]
    for i in (1, 2, 4):
        assert got[i].target_loss == pytest.approx(loss([texts[1]], texts[i]), rel=1e-5)
        assert got[i].background_loss == pytest.approx(loss(every, texts[i]), rel=1e-5)
        assert got[i].score == pytest.approx(got[i].target_loss - got[i].background_loss)
    assert lm_score.cross_entropy_difference(df.limit(0), labels).count() == 0


def test_rare_words_are_told_apart(spark, monkeypatch):
    """3,000 frequent words before them, words of one length and kind keep their own counts."""
    common = " ".join(f"w{i:05d} w{i:05d}" for i in range(3000))
    rows = [(1, common), (2, "kelvin osmium"), (3, "kelvin osmium"), (4, "barley thatch"), (4, "barley thatch"), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1)], "doc_id long, quality int")
    for hot in (lm_score.HOT, 1):  # from the broadcast and by the join
        monkeypatch.setattr(lm_score, "HOT", hot)
        out = lm_score.cross_entropy_difference(df, labels).collect()
        got = {r.doc_id: r for r in out}
        assert sorted(r.doc_id for r in out) == [i for i, _ in rows] and got[4].n_tokens == 2
        assert got[3].score < got[4].score - 1
        assert got[2].score == pytest.approx(got[3].score)


@pytest.mark.parametrize("words,hot,part", [(lm_score.WORDS, lm_score.HOT, lm_score.PART), (1, 1, 100), (30, 20, 150), (60, 1, 1 << 20)])
def test_losses_by_brute_force(spark, monkeypatch, words, hot, part):
    """Frequent and rare words and bigrams, in one part or many, score as a plain model does."""
    for name, value in (("WORDS", words), ("HOT", hot), ("PART", part)):
        monkeypatch.setattr(lm_score, name, value)
    draw = random.Random(3)
    texts = [" ".join(f"w{int(draw.paretovariate(0.7)) % 400}" for _ in range(draw.randrange(40))) for _ in range(60)] + ["", None, "only once"]
    df = spark.createDataFrame(list(enumerate([*texts, "w1 w1 w2"])), "doc_id long, text string").repartition(3)
    good = {i for i in range(60) if i % 3 == 0}
    labels = spark.createDataFrame([(i, int(i in good)) for i in range(60)], "doc_id long, quality int")
    split = {i: (t or "").split() for i, t in enumerate([*texts, "w1 w1 w2"])}
    vocabulary = max(lm_score.VOCABULARY, len({w for ws in split.values() for w in ws}))

    def model(ids):
        bi, ctx, kinds, uni = Counter(), Counter(), Counter(), Counter()
        for i in ids:
            pairs = list(zip([None, *split[i]], split[i]))
            bi.update(pairs)
            ctx.update(a for a, _ in pairs)
            uni.update(split[i])
        kinds.update(a for a, _ in bi)
        total = sum(uni.values()) + vocabulary

        def loss(ws):
            out = 0.0
            for a, b in zip([None, *ws], ws):
                rest = 0.75 * kinds[a] / ctx[a] if ctx[a] else 1.0
                out -= math.log((max(bi[a, b] - 0.75, 0) / ctx[a] if ctx[a] else 0) + rest * (uni[b] + 1) / total)
            return out / len(ws)

        return loss

    target, every = model(good), model(split)
    got = lm_score.cross_entropy_difference(df, labels).collect()
    assert sorted(r.doc_id for r in got) == sorted(split)
    for r in got:
        ws = split[r.doc_id]
        assert r.n_tokens == len(ws) and (r.score is None) == (not ws)
        if ws:
            assert r.target_loss == pytest.approx(target(ws), rel=1e-5)
            assert r.background_loss == pytest.approx(every(ws), rel=1e-5)


def test_junk_scores_worse(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    rows = lm_score.cross_entropy_difference(docs, labels).join(labels, "doc_id").select("score", "quality").collect()
    good, bad = ([r[0] for r in rows if r[1] == q and r[0] is not None] for q in (1, 0))
    assert sum(good) / len(good) < sum(bad) / len(bad)


# ---- toxicity

def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(2)
    score, trans, start = rng.standard_normal((3, 5)), rng.standard_normal((2, 2)), rng.standard_normal(2)
    p, pairs = toxicity.forward_backward(score, trans, start)
    want_pairs = np.zeros((2, 2))
    for r in range(3):
        total, marg, pr = 0.0, np.zeros(5), np.zeros((2, 2))
        for code in range(32):
            y = [(code >> k) & 1 for k in range(5)]
            w = math.exp(start[y[0]] + sum(score[r, k] * y[k] for k in range(5)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            total += w
            marg += w * np.array(y)
            for a, b in zip(y, y[1:]):
                pr[a, b] += w
        assert p[r] == pytest.approx(marg / total)
        want_pairs += pr / total
    assert pairs == pytest.approx(want_pairs)


def plain_marginals(score, trans, start):
    """A forward and a backward pass over one whole chain, in logarithms."""
    own = np.stack([np.zeros(len(score)), score], axis=1)
    a, b = [start + own[0]], [np.zeros(2)]
    for k in range(1, len(score)):
        a.append(own[k] + np.logaddexp(a[-1][0] + trans[0], a[-1][1] + trans[1]))
        b.append(np.array([np.logaddexp(*(trans[i] + own[-k] + b[-1])) for i in (0, 1)]))
    z = np.array(a) + np.array(b[::-1])
    return 1 / (1 + np.exp(z[:, 0] - z[:, 1]))


def test_chains_of_all_lengths_together():
    rng = np.random.default_rng(5)
    trans, start = 2 * rng.standard_normal((2, 2)), rng.standard_normal(2)
    chains = [4 * rng.standard_normal(n) for n in [0, *rng.permutation(np.arange(1, 201)), 1000, 0]]
    got, pairs = toxicity.forward_backward(chains, trans, start)
    assert [len(g) for g in got] == [len(c) for c in chains]
    assert all(g == pytest.approx(plain_marginals(c, trans, start), abs=1e-9) for g, c in zip(got, chains) if len(c))
    assert pairs.sum() == pytest.approx(sum(max(0, len(c) - 1) for c in chains))
    alone = [toxicity.forward_backward([c], trans, start)[0][0] for c in chains]
    assert all(np.array_equal(a, g) for a, g in zip(alone, got))  # whatever shares the batch
    extreme = [np.full(300, 80.0), np.full(300, -80.0)]
    assert all(np.isfinite(p).all() for p in toxicity.forward_backward(extreme, trans, start)[0])


def test_features_of_many_words_at_once(monkeypatch):
    """Equal to those of each word, which took most of the time when scored one by one."""
    rng, letters = np.random.default_rng(6), ["a", "B", "7", "_", "-", "'", "\xdf", "\u0130", "\u03a3", "\xe9", "\u0301", "\u4e2d", "\U0001f600", "\ud800"]
    words = sorted({"".join(rng.choice(letters, n)) for n in rng.integers(1, 16, 3000)}, key=ascii)
    each = [toxicity.feature_ids(w) for w in words]
    assert [[x for x in row if x >= 0] for row in toxicity.feature_table(words).tolist()] == each
    assert toxicity.feature_table([]).shape == (0, toxicity.WIDTH)
    field, calls = toxicity.Field(rng.normal(0, 0.1, toxicity.SIZE).astype("float32")), []
    want = [float(field.weights[ids].sum()) for ids in each]
    monkeypatch.setattr(toxicity, "feature_ids", lambda t: calls.append(t))
    monkeypatch.setattr(toxicity, "CACHE", 100)
    assert field.token_scores(words).tolist() == want
    assert field.marginals([" ".join(words), ""])[0].shape == (len(words),) and not calls


def test_last_token_counts_at_any_length():
    field = toxicity.Field()
    field.weights[toxicity.feature_ids("zork")] = 2.0
    field.trans = np.array([[1.0, -2.0], [-1.0, 1.0]])
    p = [field.marginals(["ab " * (n - 1) + "zork"])[0][-1] for n in (62, 64, 65, 128, 129)]
    assert p == pytest.approx([p[0]] * 5, abs=1e-6)


def toxic_corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 6)))
    rows = []
    for i in range(900):
        w = [word() for _ in range(rng.choice([5, 40, 150]))]
        y = int(i % 6 == 0)
        if y:
            for _ in range(rng.choice([1, 2, 5])):
                w[rng.randrange(len(w))] = rng.choice(["zorkish", "vrell" + word(), "Zorkish!"])
        rows.append((i, " ".join(w), y))
    return rows


def test_held_out_accuracy_spans_and_edges(spark):
    rows = toxic_corpus()
    extra = [(5000, None, 0), (5001, "", 0), (5002, "clean " * 30_000 + "zorkish zorkish", 1), (None, "abc", 0)]
    docs = spark.createDataFrame([(i, t, "xx", 5) for i, t, _ in rows + extra], "doc_id long, text string, lang string, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (None, 1), (99999, 1)], "doc_id long, toxic int")
    field = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, field).collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 100
    assert np.mean([got[i].predicted == y for i, y in held]) > 0.97
    assert got[5000].predicted == 0 and got[5000].score == got[5001].score and got[5002].predicted == 1
    text = dict((i, t) for i, t, _ in rows)
    hit = [(i, text[i][s.start : s.end]) for i, y in held if y for s in got[i].spans]
    assert hit and np.mean([bool(re.search("zorkish|vrell", x, re.I)) for _, x in hit]) > 0.9
    kept = toxicity.clean_documents(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    assert toxicity.score(docs.limit(0), field).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    [r] = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert 0 <= r.score <= 1


# ---- pages

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">menu %d</a></ul></nav><div class="ad">buy %d</div><div id="cookie-notice">we use cookies</div><header><h2>Site</h2></header>
<article><h1>Head&nbsp;%d</h1><p>One   <b>two</b><br>three &lt;%d&gt;<p>Second para<div>Constant note</div><ul><li>item %d<li>more</ul><section class="comments"><p>reader %d</p></section></article>
<aside>side</aside><form><p>sign up</p></form><footer>&copy; foot %d</footer>"""


def page(n):
    return PAGE % ((n,) * 7)


def test_article_only_and_wrapper(spark):
    rows = [(i, "https://h.example/%d" % i, page(i), "c") for i in range(40)]
    rows += [(100, None, None, "c"), (101, "http://[bad", "", "c"), (102, "https://one.example/", page(7), "c"), (103, "x", "<p>a<p>b &amp c", "c"), (103, "x", "<p>a<p>b &amp c", "c"), (104, "y", "<div>t1<p>t2</div>t3 < 5 <unclosed", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_extract.extract(df).collect()}
    body = "Head %d\nOne two three <%d>\nSecond para%s\nitem %d\nmore"
    assert got[5].text == body % (5, 5, "", 5)  # the constant slot is template on a host of 40 pages
    assert got[102].text == body % (7, 7, "\nConstant note", 7)
    assert got[100].text == "" and got[100].n_chars == 0 and got[101].text == ""
    assert got[103].text == "a\nb & c" and got[104].text.startswith("t1\nt2\nt3 < 5")
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_extract.extract(df).count() == len(rows) and html_extract.extract(df.limit(0)).count() == 0


def test_rare_skeletons_and_small_hosts_have_templates(spark):
    letters = lambda i: chr(97 + i // 10) + chr(97 + i % 10)
    rows = [(i, "https://big.example/", f'<article><p class="a{letters(i)}">t{i}</p></article>') for i in range(70)]
    rows += [(i, "https://big.example/", f'<article><p class="z{letters(i)}">t{i}</p><div>Constant note</div></article>') for i in range(70, 100)]
    rows += [(200 + i, "https://small.example/", f"<article><p>t{i}</p><div>Constant note</div></article>") for i in range(3)]
    rows += [(300, "https://one.example/", "<article><p>t</p><div>Constant note</div></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert all(got[i] == f"t{i}" for i in range(100)) and all(got[200 + i] == f"t{i}" for i in range(3))
    assert got[300] == "t\nConstant note"


def test_single_link_blocks_and_modifier_names_are_kept():
    text = lambda body: html_extract.Page(body).main_text()
    assert text("<h2><a href=x>Head</a></h2><p><a>AT&amp;T</a> said</p><p><a>One citation</a></p>") == "Head\nAT&T said\nOne citation"
    assert text("<ul><li><a>menu one</a><li><a>menu two</a></ul><p>body") == "body"
    assert text('<div class="content has-sidebar"><p>long body of the page</p></div><div class="sidebar">side</div>') == "long body of the page"
    assert text('<article class="article post comments-open"><p>body</p><article id="comment-1" class="comment-body">reader</article></article>') == "body"
    assert text('<p>long body of the page</p><div class="content has-sidebar">side</div>') == "long body of the page"


def test_quotes_in_unquoted_values_and_weak_names():
    text = lambda x: html_extract.Page(x).main_text().split("\n")
    assert text("<p title=don't>one</p><p>two</p><p title=can't>three</p><p>four</p>") == ["one", "two", "three", "four"]
    assert text("<p title = 'a>b' class=x>one</p><p data-q=a\"b>two</p><p title=\"x>y\">three</p>") == ["one", "two", "three"]
    assert text('<p>one</p><p title="never closed>two</p><p>three</p>') == ["one", "two", "three"]
    body = "<article><p>Start of it.</p><section class='related-work'><h2>Related work</h2><p>Others did this before.</p></section><section class=legal-analysis><p>The law says so.</p></section>"
    kept = ["Start of it.", "Related work", "Others did this before.", "The law says so."]
    tail = "<div class='related-posts'><a href=/a>Another story</a> <a href=/b>One more</a></div><div class='comment-list'><p>First!</p></div></article>"
    assert text(body + tail) == kept
    assert text("<div class='search-box'><p>Find it here</p></div><p>Plain text of the page, longer than that.</p>") == ["Plain text of the page, longer than that."]
    long = "<p " + "x" * 200_000 + "=1>in</p>" + "<p>" + "word " * 100_000 + "</p><a title='"
    assert text(long) == ["in", ("word " * 100_000).strip()]


def test_joined_rules_equal_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(i, "https://h.example/%d" % i, page(i)) for i in range(40)], "page_id long, url string, html string")
    want = sorted(tuple(r) for r in html_extract.extract(df).collect())
    monkeypatch.setattr(html_extract, "BROADCAST_RULES", -1)
    assert sorted(tuple(r) for r in html_extract.extract(df).collect()) == want


def tree(nested, depth=0):
    return "\n".join([f"{depth} {nested[0]}", *(tree(k, depth + 1) for k in nested[1:])])


def test_tree_matching():
    flat, match, grown = html_extract.flat, html_extract.match, html_extract.grown
    a = flat(tree(["r", ["a"], ["b", ["x"], ["y"]], ["c"]]))
    b = flat(tree(["r", ["b", ["y"]], ["d"], ["c"]]))
    found = match(a, b)
    assert {(b[y][1], a[x][1]) for y, x in found.items()} == {("r", "r"), ("b", "b"), ("y", "y"), ("c", "c")}
    assert match(flat(tree(["r"])), flat(tree(["s"]))) == {}
    whole = flat(grown(tree(["r", ["a"], ["c"]]), tree(["r", ["b", ["y"]], ["c"]])))
    assert [n[1] for n in whole] == ["r", "b", "y", "a", "c"]


def best_match(a, b, x=0, y=0):
    """Size of the largest match, by trying every way to pair the children in order."""
    if a[x][1] != b[y][1]:
        return 0

    def pair(p, q):
        if not p or not q:
            return 0
        return max(best_match(a, b, p[0], q[0]) + pair(p[1:], q[1:]), pair(p[1:], q), pair(p, q[1:]))

    return 1 + pair(a[x][2], b[y][2])


def test_matching_is_the_largest():
    rng = random.Random(12)
    grow = lambda d: [rng.choice("ab"), *(grow(d - 1) for _ in range(rng.randint(0, 3) if d else 0))]
    for _ in range(200):
        a, b = (html_extract.flat(tree(["r", *grow(2)[1:]])) for _ in range(2))
        found = html_extract.match(a, b)
        assert len(found) == best_match(a, b) and len(set(found.values())) == len(found)
        assert all(a[x][1] == b[y][1] for y, x in found.items())


def test_alignment_alone_finds_the_story(spark):
    """No article, no telling names: what differs from page to page is content."""
    rng = random.Random(8)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    menus, rows, want = [words(6) for _ in range(5)], [], {}
    for i in range(60):
        title, story, extra = words(4), [words(30) for _ in range(rng.randint(1, 4))], words(5) if i % 3 else ""
        body = "".join(f"<p>{x}</p>" for x in story) + (f'<div class="k8">{extra}</div>' if extra else "")
        rows.append((i, f"https://h.example/{i}", f'<div class="q1">{rng.choice(menus)}</div><div class="q2"><h2>{title}</h2>{body}</div><div class="q3">All rights held.</div>'))
        want[i] = "\n".join([title, *story, *([extra] if extra else [])])
    rows += [(100 + i, "https://h.example/copy", rows[0][2].replace("All rights", "All rights")) for i in range(60)]  # copies say nothing of a template
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for names in (True, False):
        got = {r.page_id: r.text for r in html_extract.extract(df, names=names).collect()}
        assert all(got[i] == want[i % 100 if i < 100 else 0] for i in got)


def test_deep_pages(spark):
    deep = "<div>" * 5000 + "deep words %d"
    df = spark.createDataFrame([(i, "https://d.example/", deep % i) for i in range(3)], "page_id long, url string, html string")
    assert sorted(r.text for r in html_extract.extract(df).collect()) == [f"deep words {i}" for i in range(3)]


def test_table_pages(spark, sf):
    df = spark.read.parquet(f"{sf}/pages.parquet")
    source = {r.page_id: r.html for r in df.collect()}
    for r in html_extract.extract(df).collect():
        inner = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = [re.sub(r"\s+", " ", __import__("html").unescape(re.sub(r"<[^>]*>", " " if "br" in inner else "", b))).strip() for b in re.split(r"</?(?:p|h1|ul|li|div)[^>]*>", inner)]
        assert re.sub(r"\s", "", r.text) == re.sub(r"\s", "", "".join(blocks))


# ---- pipeline

def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near-duplicates", "mixing", "packing"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    first = corpus_pipeline.drop_toxic(spark, docs, sf)
    assert first.columns == docs.columns
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in first.collect()}
    clean = [i for i, y in labels.items() if not y]
    assert sum(i in gone for i in clean) <= 0.05 * len(clean)
    second = corpus_pipeline.drop_near_copies(spark, first, sf)
    third = corpus_pipeline.mix_sources(spark, second, sf)
    assert second.columns == third.columns == docs.columns
    assert {r.doc_id for r in third.collect()} <= {r.doc_id for r in second.collect()}
    last = corpus_pipeline.pack_sequences(spark, third, sf)
    assert last.filter("piece = 0").count() == third.count()
