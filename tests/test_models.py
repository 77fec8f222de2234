"""Invariants of folds, training, calibration and attribution."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import folds as J
from tessera.operators import metrics as M
from tessera.operators import models as K
from tessera.operators.transforms import pca_features
from tessera.plans.models import ORDERS, X, sides


@pytest.fixture(scope="module")
def data(spark, sf):
    return tuple(df.cache() for df in sides(spark, sf))


def test_oof_once_and_better_than_chance(data):
    train, test = data
    oof, pred = K.train_cv(train, test, X, "y", "classification", "gbt", params={"rounds": 6, "rate": 0.3})
    assert oof.count() == train.count() == oof.select("id").distinct().count()
    assert pred.count() == test.count()
    assert M.roc_auc(oof).first()["auc"] > 0.7
    assert oof.filter("p < 0 OR p > 1").count() == 0


@pytest.mark.parametrize("family, params", [("rf", {"numTrees": 5}), ("lgb", {"rounds": 4, "rate": 0.3})])
def test_multiclass_rows_sum_to_one(data, family, params):
    oof, pred = K.train_cv(*data, X, "cls", "multiclass", family, params=params)
    bad = oof.unionByName(pred.withColumns({"fold": F.lit(0), "y": F.lit(0)})).filter(F.abs(F.aggregate("prob", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9)
    assert bad.count() == 0


def test_same_seed_same_result(data):
    a, b = (K.train_cv(*data, X, "y", "classification", "rf", params={"numTrees": 3}, seed=4)[0].agg(F.sum("p")).first()[0] for _ in range(2))
    assert a == pytest.approx(b, abs=1e-9)


def test_pseudo_rows_never_validate(data):
    train, test = data
    marked = train.withColumn("is_pseudo", F.lit(False)).unionByName(train.limit(20).withColumns({"is_pseudo": F.lit(True), "fold": F.lit(-1), "id": -F.col("id") - 1}))
    oof, _ = K.train_cv(marked, test, X, "y", "classification", "lr")
    assert oof.filter("id < 0").count() == 0 and oof.count() == train.count()


@pytest.mark.parametrize("method", ["platt", "isotonic"])
def test_calibration_is_monotone_and_not_worse(data, method):
    oof, pred = K.train_cv(*data, X, "y", "classification", "lr")
    oof = oof.withColumn("p", F.pow("p", 3)).cache()
    done, test = K.calibrate(oof, pred, method)
    brier = lambda df: df.agg(F.avg(F.pow(F.col("y") - F.col("p"), 2))).first()[0]
    assert done.count() == oof.count() and test.count() == pred.count()
    assert brier(done) <= brier(oof) + 0.01


def test_one_class_passes_through(spark):
    oof = spark.createDataFrame([(i, i % 2, 1, 0.3) for i in range(10)], "id long, fold int, y int, p double")
    assert K.calibrate(oof, oof.select("id", "p"))[0].filter("p <> 0.3").count() == 0


def test_folds(spark, sf):
    o = ORDERS.df(spark, sf).drop("fold")
    for kind, more in (("kfold", {}), ("stratified", {"y": "y"}), ("group", {"group": "cust"})):
        f = J.assign_folds(o, kind, 5, 3, "id", **more)
        n = [r[1] for r in f.groupBy("fold").count().collect()]
        assert sum(n) == o.count() and len(n) == 5 and max(n) - min(n) < 0.2 * max(n)
    assert J.assign_folds(o, "GroupKFold", 5, 3, "id", group="cust").groupBy("cust").agg(F.count_distinct("fold").alias("k")).filter("k > 1").count() == 0
    a, b = (J.assign_folds(o, "kfold", 5, s, "id") for s in (3, 4))
    assert a.join(b.select("id", F.col("fold").alias("g")), "id").filter("fold = g").count() < 0.5 * o.count()
    with pytest.raises(ValueError):
        J.assign_folds(o, "group", 5, 0, "id")
    with pytest.raises(ValueError):
        J.spatial_blocks(spark.createDataFrame([(1, 0.0, 0.0)], "id long, lat double, lon double"), "lat", "lon", 4)


def test_large_group_count_is_spread(spark, monkeypatch):
    monkeypatch.setattr(J, "GREEDY_GROUPS", 5)
    df = spark.range(300).withColumn("g", F.col("id") % 40)
    f = J.group_folds(df, "g", 4)
    assert f.count() == 300 and f.groupBy("g").agg(F.count_distinct("fold").alias("k")).filter("k > 1").count() == 0


def test_many_groups_leave_room_for_a_large_one(spark, monkeypatch):
    monkeypatch.setattr(J, "GREEDY_GROUPS", 20)  # 600 of 1,800 rows in one group, 400 groups of three
    df = spark.range(1800).withColumn("g", F.when(F.col("id") < 600, -1).otherwise(F.col("id") % 400))
    f = J.group_folds(df, "g", 4)
    n = {r["fold"]: r["count"] for r in f.groupBy("fold").count().collect()}
    assert sorted(n.values())[-1] == 600 and all(abs(x - 400) <= 3 for x in sorted(n.values())[:-1])
    assert f.count() == 1800 and f.groupBy("g").agg(F.count_distinct("fold").alias("k")).filter("k > 1").count() == 0


def test_choose_cv():
    assert J.choose_cv({"temporal": True}) == "time" and J.choose_cv({"minority": 0.1}) == "stratified" and J.choose_cv({"minority": 0.4}) == "kfold"
    assert J.choose_cv({"spatial": True, "points": 4, "minority": 0.4}) == "kfold" and J.choose_cv({"group": "g"}) == "group" and J.choose_cv({}, "TimeSeriesSplit") == "time"
    assert J.strategy_id("KFold") == "config:KFold" and J.strategy_id("KFold", "GroupKFold") == "override:GroupKFold" and J.strategy_id() == "unknown"


def test_pca_sign_is_fixed(spark):
    df = spark.createDataFrame([(i, float(i), 2.0 * i + (i % 3), 0.0) for i in range(30)], "id long, a double, b double, c double")
    train, test = pca_features(df, df, ["a", "b", "c"], 5)
    assert [c for c in train.columns if c.startswith("pca")] == ["pca_1", "pca_2", "pca_3"]
    assert train.agg(F.corr("pca_1", "a")).first()[0] > 0.9
    assert pca_features(df, df, ["a"], 2)[0].columns == df.columns


def test_self_training_goes_on_from_its_last_round(spark, data, tmp_path, monkeypatch):
    train, test = data
    small, other = train.filter("id % 5 = 1"), test.filter("id % 5 = 2")
    args = dict(columns=X, y="y", rounds=2, seeds=2, params={"gbt": {"rounds": 3, "rate": 0.5}, "rf": {"numTrees": 3, "maxDepth": 4}})
    whole, facts = K.pseudo_label(small, other, state=str(tmp_path / "a"), **args)
    plain, calls = K.train_cv, []

    def fails(*a, **more):
        calls.append(a[5])
        if len(calls) == 5:  # in the middle of round 1
            raise OSError("lost")
        return plain(*a, **more)

    monkeypatch.setattr(K, "train_cv", fails)
    with pytest.raises(OSError):
        K.pseudo_label(small, other, state=str(tmp_path / "b"), **args)
    calls[:] = [None] * 10
    again, same = K.pseudo_label(small, other, state=str(tmp_path / "b"), **args)
    n = len(same.collect())
    assert len(calls) == 10 + 3 * (n - 1)  # round 0 is not run again
    assert [tuple(r) for r in same.collect()] == [(r["round"], pytest.approx(r["f1"]), r["pseudo_rows"]) for r in facts.collect()]
    both = whole.join(again.withColumnRenamed("p", "q"), ["id", "fold", "y"])
    assert both.count() == small.count() and both.filter("abs(p - q) > 1e-9").count() == 0
    assert facts.filter("round = 0").first()["pseudo_rows"] == 0 and facts.filter("round = 1 AND pseudo_rows > 0").count() == 1
    with pytest.raises(ValueError):
        K.pseudo_label(small, other, state=str(tmp_path / "b"), **{**args, "seeds": 3})


def test_k_means_starts_share_their_scans(spark, monkeypatch):
    import numpy as np

    from tessera.operators import clustering as C

    rng = np.random.default_rng(4)
    middle = np.array([[0, 0, 0], [5, 0, 0], [0, 5, 0], [0, 0, 5.0]])
    x = np.concatenate([m + 0.1 * rng.standard_normal((30, 3)) for m in middle])
    df = spark.createDataFrame([(*map(float, p), 1 + i % 4) for i, p in enumerate(x)], "a double, b double, c double, w long").withColumn("h", F.xxhash64("a", "b", "c")).repartition(3)
    centres, cost, scans = C.k_means(df, ["a", "b", "c"], 4, seed=2)
    w = np.array([1 + i % 4 for i in range(len(x))])
    want = np.array([np.average(x[k * 30 : k * 30 + 30], axis=0, weights=w[k * 30 : k * 30 + 30]) for k in range(4)])
    assert np.allclose(sorted(map(tuple, centres)), sorted(map(tuple, want)), atol=1e-3)
    assert cost == pytest.approx((w * C.square_distances(x, centres).min(1)).sum())
    one = C.k_means(df, ["a", "b", "c"], 4, seed=2, starts=1)
    assert one[1] >= cost - 1e-9 and scans <= 2 * C.ROUNDS + C.STEPS + 2 and one[2] <= scans
    again = C.k_means(df.repartition(5), ["a", "b", "c"], 4, seed=2)
    assert np.allclose(again[0], centres)
    u = C.uniform(np.arange(20_000), 1, 2)
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01


def test_spatial_folds_and_their_fallback(spark):
    places = [(i, 10.0 * (i % 6), 20.0 * (i % 6), i % 2, int(i % 12 == 0)) for i in range(120)] + [(900, None, 3.0, 0, 0)]
    df = spark.createDataFrame(places, "id long, lat double, lon double, y int, rare int")
    kind, f = J.folds_by_profile(df, {"spatial": True, "points": 120}, 3, 1, "id", lat="lat", lon="lon")
    assert kind == "spatial" and f.count() == 121
    assert f.groupBy("lat", "lon").agg(F.count_distinct("fold").alias("k")).filter("k > 1").count() == 0
    assert f.filter("fold IS NULL").count() == 0 and f.select("fold").distinct().count() == 3
    few = {"spatial": True, "points": 120, "minority": 0.08}
    kind, f = J.folds_by_profile(df, few, 8, 1, "id", y="rare", lat="lat", lon="lon")
    assert kind == "stratified" and f.filter("rare = 1").groupBy("fold").count().agg(F.max("count") - F.min("count")).first()[0] <= 1
    assert J.folds_by_profile(df, {"spatial": True, "points": 9, "minority": 0.4}, 4, 1, "id")[0] == "kfold"


def test_all_sides_are_fitted_at_once(spark, monkeypatch):
    import random

    rng = random.Random(2)
    rows = [(i, i % 4, 1e6 + rng.gauss(0, 3) if i % 7 else None, float(rng.randrange(5)), 2.5, None, i % 2) for i in range(200)] + [(900, -1, 1e6 + 50, 9.0, 2.5, None, 1)]
    df = spark.createDataFrame(rows, "id long, fold int, a double, b double, c double, d double, y int").withColumn("_pseudo", F.col("id") == 900)
    cols, calls, plain = ["a", "b", "c", "d"], [], K.quantiles
    monkeypatch.setattr(K, "quantiles", lambda *a: calls.append(1) or plain(*a))
    for scale in (True, False):
        fits = K.fold_fits(df, cols, [0, 1, 2, 3], scale)
        for f in range(4):
            one, _ = K.prepared(df.filter((F.col("fold") != f) | F.col("_pseudo")), df, cols, "y", scale)
            got = K.fitted(df.filter((F.col("fold") != f) | F.col("_pseudo")), fits[f])
            want = {r.id: list(r._x) for r in one.select("id", "_x").collect()}
            assert {r.id: list(r._x) for r in got.select("id", "_x").collect()} == {i: pytest.approx(v, abs=1e-6) for i, v in want.items()}
    assert len(calls) == 2


def test_seeds_share_one_preparation(spark, monkeypatch):
    """Each seed spread, read and fitted its folds anew; the results are those of each alone."""
    df = spark.range(300).selectExpr("id", "CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b", "CAST(id % 17 > 8 AS INT) AS y", "CAST(id % 3 AS INT) AS fold")
    fits, plain = [], K.fold_fits
    monkeypatch.setattr(K, "fold_fits", lambda *a: fits.append(1) or plain(*a))
    small = {"numTrees": 2, "maxDepth": 2}
    oof, test = K.multi_seed(df, df.drop("y", "fold"), ["a", "b"], "y", "classification", "rf", seed=4, n=2, params=small)
    assert len(fits) == 1
    each = [K.train_cv(df, df.drop("y", "fold"), ["a", "b"], "y", "classification", "rf", params=small, seed=s) for s in (4, 5)]
    for side, got in enumerate((oof, test)):
        want = [{r["id"]: r["p"] for r in e[side].collect()} for e in each]
        found = {r["id"]: r["p"] for r in got.collect()}
        assert len(found) == 300 and all(abs(found[i] - (want[0][i] + want[1][i]) / 2) < 1e-9 for i in found)


def test_calibration_of_all_sides_from_the_same_scans(spark):
    """Slopes and intercepts are those of one regression a side and class, found
    without one run of jobs for each of them."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(4)
    prob, fold = rng.dirichlet([1, 2, 3], 600), rng.integers(0, 4, 600)
    y = [int(rng.choice(3, p=p)) for p in prob]
    oof = spark.createDataFrame([(i, int(fold[i]), y[i], prob[i].tolist()) for i in range(600)], "id long, fold int, y int, prob array<double>")
    spark.sparkContext.setJobGroup("calibrated", "")
    done, test = K.calibrate_multiclass(oof, oof.select("id", "prob"), 3)
    got = {r["id"]: r["prob"] for r in done.collect()}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("calibrated")) < 40
    spark.sparkContext.setJobGroup("", "")
    pack = VectorAssembler(inputCols=["p"], outputCol="_x")
    for f in (1, 3):
        raw = []
        for c in range(3):
            side = pack.transform(oof.filter(F.col("fold") != f).select(F.col("prob")[c].alias("p"), (F.col("y") == c).cast("double").alias("_y")))
            m = LogisticRegression(featuresCol="_x", labelCol="_y", standardization=False, regParam=1.0 / side.count(), tol=1e-12).fit(side)
            raw.append(1 / (1 + np.exp(-(m.coefficients[0] * prob[:, c] + m.intercept))))
        want = (np.array(raw) / np.sum(raw, axis=0)).T
        assert max(np.abs(np.array(got[i]) - want[i]).max() for i in range(600) if fold[i] == f) < 1e-5
    assert len(got) == 600 and test.count() == 600


def test_logistic_folds_from_the_same_scans(spark):
    """All folds in few jobs, each the regression that Spark ML finds when it goes to
    the end: with nulls, weights, a column of one value and rows that train only."""
    from pyspark.ml.classification import LogisticRegression

    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        a, b = float(rng.normal(50, 9)), float(rng.integers(0, 4))
        rows.append((i, i % 5 if i < 880 else None, i >= 880, float(rng.integers(1, 4)), None if i % 7 == 0 else a, b, 2.5, int(rng.random() < 1 / (1 + np.exp(50 - a - b)))))
    df = spark.createDataFrame(rows, "id long, fold int, is_pseudo boolean, weight double, a double, b double, c double, y int")
    cols, test = ["a", "b", "c"], df.drop("fold", "y", "is_pseudo", "weight")
    test = test.unionByName(test.filter("id < 5"))  # rows that repeat count as one
    spark.sparkContext.setJobGroup("folds", "")
    oof, pred = K.train_cv(df, test, cols, "y", "classification", "lr")
    got, mean = {r["id"]: r["p"] for r in oof.collect()}, {r["id"]: r["p"] for r in pred.collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("folds"))
    spark.sparkContext.setJobGroup("", "")
    assert jobs < 60 and len(got) == 880 and len(mean) == 900 and pred.count() == 900
    marked = df.withColumn("_pseudo", F.col("is_pseudo"))
    fits, every = K.fold_fits(marked, cols, list(range(5)), True), {i: 0.0 for i in mean}
    for f in range(5):
        side = K.fitted(marked.filter((F.col("fold") != f) | F.col("_pseudo")), fits[f]).withColumn("_y", F.col("y").cast("double"))
        model = LogisticRegression(featuresCol="_x", labelCol="_y", weightCol="weight", maxIter=1000, tol=1e-14).fit(side)
        want = {r["id"]: (r["fold"], r["p"]) for r in K.predicted(model, K.fitted(marked, fits[f]), "classification", ["id", "fold"]).collect()}
        assert all(abs(got[i] - p) < 1e-6 for i, (g, p) in want.items() if g == f)
        every = {i: p + want[i][1] / 5 for i, p in every.items()}
    assert all(abs(mean[i] - every[i]) < 1e-6 for i in mean)


def test_folds_without_a_finite_regression_go_to_spark_ml(spark):
    """One class only, classes wholly told apart, missing values: as Spark ML has it."""
    df = spark.range(120).selectExpr("id", "CAST(id % 3 AS INT) AS fold", "CAST(id AS DOUBLE) AS a", "CAST(id % 3 = 0 AS INT) AS one", "CAST(id > 60 AS INT) AS apart")
    marked, test = df.withColumn("_pseudo", F.lit(False)), df.select("id", "a")
    fits = K.fold_fits(marked, ["a"], [0, 1, 2], True)
    assert set(K.logistic(marked, ["a"], "one", fits)) == {1, 2}
    assert K.logistic(marked, ["a"], "apart", fits) == {}
    assert set(K.logistic(marked.withColumn("one", F.when(F.col("id") != 4, F.col("one"))), ["a"], "one", fits)) == {1}
    oof, pred = K.train_cv(df, test, ["a"], "one", "classification", "lr")
    assert oof.count() == pred.count() == 120 and oof.filter("p IS NULL OR isnan(p) OR p < 0 OR p > 1").count() == 0
    assert {r["p"] for r in oof.filter("fold = 0").collect()} == {0.0}
