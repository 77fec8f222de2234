"""Histogram boosting against plain searches over all rows, and its attribution
against all coalitions."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import boosting as B
from tessera.operators import metrics as M
from tessera.operators import models as K

P = {"rounds": 4, "rate": 0.3, "leaves": 6, "min_rows": 5, "patience": 50}


def rows(seed, n=360, classes=2):
    rng = np.random.default_rng(seed)
    x = np.round(rng.standard_normal((n, 3)), 1)
    x[rng.random((n, 3)) < 0.15] = np.nan
    full = np.nan_to_num(x)
    signal = full[:, 0] + 2 * (full[:, 1] > 0.3) * full[:, 2] + np.isnan(x[:, 1]) + rng.standard_normal(n) * 0.4
    if classes > 2:
        y = np.digitize(signal, np.quantile(signal, [k / classes for k in range(1, classes)]))
    else:
        y = (signal > 0.5).astype(int)
    return x, y.astype(float), rng.integers(1, 4, n).astype(float)


def frame(spark, x, y, w, folds=1, fold=None):
    """A row for each model; fold None: nothing to validate."""
    n = [None if np.isnan(v) else float(v) for v in x.reshape(-1)]
    data = [(i, float(y[i]), float(w[i]), int(fold[i]) if fold is not None else -1, *n[3 * i : 3 * i + 3]) for i in range(len(y))]
    df = spark.createDataFrame(data, "id long, y double, weight double, fold int, a double, b double, c double").repartition(3)
    return df.withColumn("model", F.explode(F.array(*map(F.lit, range(folds))))).withColumn("valid", F.col("fold") == F.col("model"))


def plain_tree(x, g, h, edges, p):
    """Best leaf first, every split tried on the rows themselves."""
    score = lambda at: g[at].sum() ** 2 / (h[at].sum() + 1e-300)

    def best(at):
        found = None
        for missing_left in (False, True):
            for c in range(x.shape[1]):
                for cut in edges[c]:
                    left = np.where(np.isnan(x[at, c]), missing_left, x[at, c] <= cut)
                    a, b = at[left], at[~left]
                    if min(len(a), len(b)) < p["min_rows"] or min(h[a].sum(), h[b].sum()) < 1e-3:
                        continue
                    gain = score(a) + score(b) - score(at)
                    if gain > 1e-12 and (found is None or gain > found[0] + 1e-9):
                        found = (gain, c, float(cut), missing_left, a, b)
        return found

    nodes = [{"at": np.arange(len(g))}]
    nodes[0]["best"], open_ = best(nodes[0]["at"]), [0]
    while len(open_) < p["leaves"] and any(nodes[i]["best"] for i in open_):
        i = max((i for i in open_ if nodes[i]["best"]), key=lambda i: nodes[i]["best"][0])
        open_.remove(i)
        for at in nodes[i]["best"][4:]:
            nodes.append({"at": at, "best": best(at)})
            open_.append(len(nodes) - 1)
        nodes[i]["split"] = nodes[i]["best"][1:4]
    leaf_value = lambda at: -p["rate"] * g[at].sum() / h[at].sum()
    return sorted(((tuple(sorted(nodes[i]["at"])), leaf_value(nodes[i]["at"])) for i in open_), key=lambda t: t[0])


@pytest.mark.parametrize("objective, classes", [("binary", 2), ("squared", 2), ("poisson", 2), ("softmax", 3)])
def test_trees_equal_a_plain_search(spark, monkeypatch, objective, classes):
    monkeypatch.setattr(B, "BLOCK", 50)
    monkeypatch.setattr(B, "EVERY", 2)
    if objective in ("binary", "softmax"):
        monkeypatch.setattr(B, "ADDED_BYTES", 0)  # sums meet in a shuffle
    x, y, w = rows(1, classes=classes)
    df = frame(spark, x, y, w)
    fit = B.boost(df, ["a", "b", "c"], objective, classes, P)
    edges = B.bin_edges(df, ["a", "b", "c"])[0]
    loss = fit.objective
    score = np.tile(fit.start[0], (len(y), 1))
    assert len(fit.rounds[0]) == P["rounds"]
    for trees in fit.rounds[0]:
        g, h = (d * w[:, None] for d in loss.derivatives(score, y))
        for k, t in enumerate(trees):
            leaf = t.leaf_of(x)
            got = sorted((tuple(np.flatnonzero(leaf == v)), t.value[v]) for v in np.unique(leaf))
            want = plain_tree(x, g[:, k], h[:, k], edges, P)
            assert [r for r, _ in got] == [r for r, _ in want]
            assert np.allclose([v for _, v in got], np.clip([v for _, v in want], -0.21, 0.21) if objective == "poisson" else [v for _, v in want])
            assert np.allclose(t.count[np.unique(leaf)], np.unique(leaf, return_counts=True)[1])
            score[:, k] += t.value[leaf]
    got = {r.id: r[-1] for r in fit.predict(df.select("id", "a", "b", "c"), ["id"]).collect()}
    want = loss.predict(score)
    assert all(np.allclose(got[i], want[i] if classes > 2 else want[i, 0]) for i in range(len(y)))


@pytest.mark.parametrize("objective, classes", [("binary", 1), ("squared", 1), ("softmax", 4)])
def test_derivatives_are_those_of_the_loss(objective, classes):
    rng = np.random.default_rng(2)
    loss = B.Objective(objective, classes)
    y = rng.integers(0, max(2, classes), 50).astype(float)
    s, e = rng.standard_normal((50, classes)), 1e-5
    g, h = loss.derivatives(s, y)
    scale = 0.5 if objective == "squared" else 1.0
    for k in range(classes):
        up, down = s.copy(), s.copy()
        up[:, k] += e
        down[:, k] -= e
        assert np.allclose(g[:, k], scale * (loss.losses(up, y) - loss.losses(down, y)) / (2 * e), atol=1e-6)
        second = (loss.derivatives(up, y)[0] - loss.derivatives(down, y)[0])[:, k] / (2 * e)
        assert np.allclose(h[:, k], second * (classes / (classes - 1) if classes > 1 else 1), atol=1e-6)
    g, h = B.Objective("poisson").derivatives(s[:, :1], y)
    assert np.allclose(g[:, 0], np.exp(s[:, 0]) - y) and np.allclose(h[:, 0], np.exp(s[:, 0] + 0.7))


def test_models_grow_side_by_side_and_stop_at_the_best_round(spark, monkeypatch):
    x, y, w = rows(3)
    fold = np.arange(len(y)) % 3
    passes = []
    plain = B.one_pass
    monkeypatch.setattr(B, "one_pass", lambda *a: passes.append(1) or plain(*a))
    p = P | {"rounds": 40, "rate": 0.9, "patience": 3, "min_rows": 2}
    three = B.boost(frame(spark, x, y, w, 3, fold), ["a", "b", "c"], "binary", 1, p)
    together = len(passes)
    passes.clear()
    each = []
    for m in range(3):
        one = B.boost(frame(spark, x, y, w, 3, fold).filter(F.col("model") == m), ["a", "b", "c"], "binary", 1, p)
        each.append(len(passes))
        passes.clear()
        assert len(one.rounds[m]) == len(three.rounds[m])
        assert np.allclose(one.score(x, m), three.score(x, m))
    assert together < sum(each)
    for m in range(3):
        h = three.history[m]
        best = int(np.argmin(h[1:])) + 1
        assert len(three.rounds[m]) == best and (len(h) - 1 == best + p["patience"] or len(h) - 1 == p["rounds"])
        own = fold == m
        assert np.isclose(np.average(three.objective.losses(three.score(x[own], m), y[own]), weights=w[own]), h[best])


def test_edges_of_training(spark):
    x, y, w = rows(4, 60)
    df = frame(spark, x, y, w)
    assert B.boost(df.filter("id < 0"), ["a"]).rounds == {}
    alone = B.boost(df, [], "binary", 1, P)
    assert alone.rounds == {0: []} and np.allclose(alone.objective.predict(alone.start[0]), (y * w).sum() / w.sum())
    none = B.boost(df.withColumn("y", F.lit(1.0)), ["a", "b", "c"], "binary", 1, P)
    assert all(len(t.feature) == 1 for trees in none.rounds[0] for t in trees)
    nulls = B.boost(df.withColumn("a", F.lit(None).cast("double")), ["a"], "squared", 1, P)
    assert all(len(t.feature) == 1 for trees in nulls.rounds[0] for t in trees)


def coalition(t, x, known):
    """Mean of a tree where columns outside `known` split rows by counts."""

    def walk(v):
        if t.feature[v] < 0:
            return t.value[v]
        c, l, r = t.feature[v], t.left[v], t.right[v]  # noqa: E741
        if c in known:
            return walk(l if (t.missing_left[v] if np.isnan(x[c]) else x[c] <= t.cut[v]) else r)
        return (t.count[l] * walk(l) + t.count[r] * walk(r)) / t.count[v]

    return walk(0)


@pytest.mark.parametrize("classes", [2, 3])
def test_attribution_equals_all_coalitions(spark, classes):
    x, y, w = rows(5, classes=classes)
    fold = np.arange(len(y)) % 2
    df = frame(spark, x, y, w, 2, fold)
    fit = B.boost(df, ["a", "b", "c"], "softmax" if classes > 2 else "binary", classes, P | {"leaves": 12})
    one = frame(spark, x, y, w, 1, fold).filter("id < 40")
    got = {(r.fold, r.id, r.feature): r["value"] for r in B.shap_values(fit, one, "id", "fold").collect()}
    assert len(got) == 120
    for i in range(40):
        trees = [t[-1] for t in fit.rounds[int(fold[i])]]
        for j, name in enumerate("abc"):
            rest = [c for c in range(3) if c != j]
            want = sum(factorial(k) * factorial(2 - k) / 6 * sum(coalition(t, x[i], {*s, j}) - coalition(t, x[i], set(s)) for t in trees) for k in range(3) for s in combinations(rest, k))
            assert got[int(fold[i]), i, name] == pytest.approx(want, abs=1e-9)


def test_boosted_folds_beat_chance(spark):
    x, y, w = rows(6, 600, 3)
    df = frame(spark, x, y, w, 1, np.arange(600) % 3).drop("model", "valid", "weight").withColumn("y", F.col("y").cast("int"))
    oof, test = K.train_cv(df, df.drop("y", "fold"), ["a", "b", "c"], "y", "multiclass", "lgb", params={"rounds": 20, "rate": 0.2})
    assert oof.count() == test.count() == 600
    guess = oof.select("y", F.expr("array_position(prob, array_max(prob)) - 1").alias("guess"))
    assert guess.filter("y = guess").count() > 0.55 * 600
    counts, _ = K.train_cv(df, df.drop("y", "fold"), ["a", "b", "c"], "y", "regression", "poisson", params={"rounds": 20, "rate": 0.2})
    assert counts.filter("p <= 0").count() == 0
    mean = df.agg(F.avg("y")).first()[0]
    error = counts.agg(F.avg(F.pow(F.col("y") - F.col("p"), 2)), F.avg(F.pow(F.col("y") - mean, 2))).first()
    assert error[0] < 0.8 * error[1]
    extra = lambda a, b, f: (a.withColumn("d", F.col("a") * 2), b.withColumn("d", F.col("a") * 2))
    own, _ = K.train_cv(df.withColumn("y", (F.col("y") > 0).cast("int")), df.drop("y", "fold"), ["d", "b", "c"], "y", "classification", "lgb", params={"rounds": 10, "rate": 0.3}, features=extra)
    assert M.roc_auc(own).first()["auc"] > 0.75


def test_one_row_group_is_learned_from_by_many_tasks(spark, tmp_path, monkeypatch):
    """A file of one row group was read, and so trained on, by one task."""
    path = str(tmp_path / "rows")
    spark.range(400).selectExpr("id", "CAST(id % 7 AS DOUBLE) AS x", "CAST(id % 2 AS INT) AS y", "CAST(id % 3 AS INT) AS fold").coalesce(1).write.parquet(path)
    used = []

    def seen(rows, *a, **k):
        used.append(rows.select(F.spark_partition_id()).distinct().count())
        raise KeyboardInterrupt

    monkeypatch.setattr(K, "boost", seen)
    train = spark.read.parquet(path)
    for run in (lambda: K.train_cv(train, train, ["x"], "y", "classification", "lgb"), lambda: K.boosted(train.withColumn("_pseudo", F.lit(False)), ["x"], "y", "classification")):
        with pytest.raises(KeyboardInterrupt):
            run()
    assert used[0] >= 4 and used[1] == 1


@pytest.mark.parametrize("cells", [0, 30, 1 << 12])
def test_leaves_and_attribution_by_cells_equal_a_walk(monkeypatch, cells):
    """Also where only parts of a tree, or none, have few enough cells."""
    monkeypatch.setattr(B, "CELLS", cells)
    x, y, _ = rows(7, 500)
    edges = [np.unique(c[~np.isnan(c)])[:-1] for c in x.T]
    bins = np.stack([np.where(np.isnan(c), B.MISSING, np.searchsorted(e, c, "left")) for c, e in zip(x.T, edges)]).astype("uint8")
    t = plain_growth(edges, bins, y - y.mean(), P | {"leaves": 16} | {k: B.DEFAULTS[k] for k in ("min_hessian", "l2")})[0]

    def walk(v, row):
        while t.feature[v] >= 0:
            at = row[t.feature[v]]
            v = t.left[v] if (t.missing_left[v] if np.isnan(at) else at <= t.cut[v]) else t.right[v]
        return v

    want = [walk(0, row) for row in x]
    assert (t.leaf_of(x) == want).all() and (t.leaf_of_bins(bins) == want).all()
    a, b = np.zeros(x.shape), np.zeros(x.shape)
    B.tree_shap(t, x, a)
    B.tree_attribution(t, x, b)
    assert np.allclose(a, b, atol=1e-12)


def plain_growth(edges, bins, g, p):
    """A tree by a Grower whose passes are plain sums, and the number of passes."""
    grower, passes = B.Grower(edges, p), 0
    while asked := grower.wanted(1 << 20):
        tree, slots = grower.tentative(asked)
        leaf, hists = tree.leaf_of_bins(bins), [None] * len(asked)
        for node, k in slots.items():
            at = np.flatnonzero(leaf == node)
            hists[k] = np.array([[np.bincount(b[at], v[at], 256) for b in bins] for v in (g, np.ones(len(g)), np.ones(len(g)))])
        grower.tell(asked, hists)
        passes += 1
    return grower.tree.packed(), passes


def test_a_tree_takes_about_a_pass_a_level():
    """Best leaf first, a pass was taken for nearly every split of a skewed tree."""
    # runs of equal targets: best splits cut one run after the other
    v = np.concatenate([np.full(64, k) for k in range(24)])
    y = np.concatenate([np.tile([3.0**-k, 3.0**-k], 32) * (1 if k % 2 else -1) for k in range(24)])
    u = np.tile(np.arange(64), 24)
    edges, p = [np.arange(23.0), np.arange(63.0)], P | {"leaves": 20, "min_hessian": 1e-3, "l2": 0.0}
    t, passes = plain_growth(edges, np.stack([v, u]).astype("uint8"), y, p)
    depth = lambda n: 0 if t.feature[n] < 0 else 1 + max(depth(t.left[n]), depth(t.right[n]))
    assert passes <= depth(0) + 1 or passes < 12, (passes, depth(0))


@pytest.mark.parametrize("x", [[3.5] * 8, [0.0, 1.0, 255.0] * 3, [256.0, 1.0], [0.5, 1.0], [-0.0, 1.0], [0.0, -0.0], [-1.0, 2.0], [7.0], [np.nan, 1.0], [np.inf, 0.0]])
def test_blocks_keep_their_numbers(x):
    back = B._whole(B._short(np.array(x)), len(x))
    assert back.tobytes() == np.array(x).tobytes()
    assert len(B._short(np.zeros(1000))) == 9 and len(B._short(np.arange(1000.0) % 2)) == 1001


def test_blocks_grow_with_different_rows_only(spark):
    """Copies of rows add to how many a place stands for, not to what a pass reads."""
    x, y, w = rows(5)
    found = {}
    for times in (1, 7):
        df = frame(spark, *(np.concatenate([v] * times) for v in (x, y, w)))
        edges = {0: [np.unique(c[~np.isnan(c)])[:-1] for c in x.T]}
        blocks = B.block_table(df, ["a", "b", "c"], edges, {0: np.zeros(1)}).toArrow()
        opened = [B._opened(b, i, 3, 1) for b in blocks.to_batches() for i in range(b.num_rows)]
        places = [(tuple(bins[:, k].tolist()), float(ys[k]), float(ws[k] / n[k])) for _, bins, ys, ws, n, _, _ in opened for k in range(len(ys))]
        found[times] = sorted(places), sum(n.sum() for _, _, _, _, n, _, _ in opened), sum(ws.sum() for _, _, _, ws, _, _, _ in opened)
    assert found[1][0] == found[7][0] and len(set(found[7][0])) == len(found[7][0])
    assert [found[t][1:] for t in (1, 7)] == [(360 * t, w.sum() * t) for t in (1, 7)]


@pytest.mark.parametrize("different", [0, 1, 5, 3000])
def test_combined_keeps_all_rows(different):
    rng = np.random.default_rng(different)
    at = rng.integers(0, max(different, 1), 2000 if different else 0)
    bins, y, w = rng.integers(0, 256, (2, 3000)).astype("uint8")[:, at], (at % 3 - 0.0) * np.where(at % 2, 1.0, -1.0), 1.0 + at % 5
    n = rng.integers(1, 4, len(at))
    _, *got = B.combined(bins, y, w, n)
    tell = lambda b, y, w, n: sorted((*b[:, k].tolist(), y[k].tobytes(), w[k], int(n[k])) for k in range(len(y)))
    want: dict = {}
    for *own, k in tell(bins, y, w, n):
        want[tuple(own)] = want.get(tuple(own), 0) + k
    assert tell(*got) == sorted((*own, k) for own, k in want.items())
