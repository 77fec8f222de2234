"""Hand-computed cases of operators without SQL, and edge cases."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import gates as G
from tessera.operators import joins, ledger, metrics, profile, select, sets, text, transforms, windows
from tessera.sources import tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_sources_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, -9999.0)], "id long, s string, v double")
    path = f"file://{tmp_path}"
    df.write.option("header", True).csv(f"{path}/t.csv")
    df.write.parquet(f"{path}/t.parquet")
    df.write.json(f"{path}/t.json")
    for kind in ("csv", "parquet", "json"):
        back = tables.read_table(spark, f"{path}/t.{kind}", schema=df.schema)
        assert rows(back.select("id", "s", "v")) == rows(df)
    assert tables.read_table(spark, f"{path}/t.csv").schema["v"].dataType.simpleString() == "double"
    assert rows(tables.mask_to_null(df).select("v")) == [(2.5,), (None,)]
    found = tables.load_manifest(spark, path, {"a": "t.csv", "b": "none.csv"})
    assert list(found) == ["a"]
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert rows(tables.nan_to_null(nan)) == [(1.0,), (None,)]


def test_sinks(spark, tmp_path):
    path, df = f"file://{tmp_path}", spark.createDataFrame([(2, 0.2), (1, 0.1)], "id long, p double")
    for _ in range(2):  # a rerun replaces its own partition only
        tables.write_predictions(df, f"{path}/preds", "b0", "y", "oof")
    tables.write_predictions(df.limit(1), f"{path}/preds", "b1", "y", "oof")
    assert spark.read.parquet(f"{path}/preds").groupBy("branch").count().orderBy("branch").collect() == [("b0", 2), ("b1", 1)]
    tables.write_features(df, f"{path}/features", "b0")
    assert spark.read.parquet(f"{path}/features").count() == 2
    names = [tables.write_submission(df, f"{path}/subs", "x", "id") for _ in range(2)]
    assert [n.rsplit("/", 1)[1] for n in names] == ["sub_001_x", "sub_002_x"]
    assert spark.read.option("header", True).csv(names[0]).first()["id"] == "1"


def test_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 0.1, "e")], "ID long, f1 double, name string, Latitude double, user_email string")
    assert select.feature_columns(df, ids=["id"]) == ["f1", "name", "user_email"]
    assert select.feature_columns(df, ids=["id"], numeric_only=True) == ["f1"]
    assert rows(select.pii_columns(df)) == [("name",), ("user_email",)]
    assert rows(select.policy_gate(df, ["LATITUDE", "z"])) == [("Latitude",)]
    assert select.numeric_columns(df) == ["ID", "f1", "Latitude"]
    test = df.drop("f1").withColumn("extra", F.lit(1))
    assert rows(select.schema_parity(df, test, "f1")) == [("extra", "extra_in_test")]
    assert rows(select.schema_parity(df, df, "y")) == [("y", "target_missing")]
    assert rows(select.validate_variant_lists(df, {"v": ["f1", "y", "d", "gone"]}, "y", ["d"], [])) == [("v", "d", "dead"), ("v", "gone", "not_in_test"), ("v", "y", "target")]
    for spec in ({"polynomials": ["y"]}, {"ratios": [("a", "y")]}, {"conditions": [{"column": "y"}]}):
        with pytest.raises(ValueError):
            select.target_leak_guard(spec, "y")
    assert [select.select_variant(df, f"v{k}", ["f1", "name", "Latitude", "user_email"], ["ID"]).columns[1:] for k in "0189"] == [["f1", "name"], ["Latitude", "user_email"], ["Latitude", "user_email"], ["f1", "Latitude"]]


def test_correlations_of_lines(spark):
    df = spark.createDataFrame([(i, 2 * i, 6 - i) for i in range(1, 6)], "feature_a int, feature_b int, feature_c int")
    assert [(r.a, r.b, round(r.r, 9)) for r in profile.high_corr_pairs(df).collect()] == [("feature_a", "feature_b", 1.0), ("feature_a", "feature_c", -1.0), ("feature_b", "feature_c", -1.0)]


def test_outlier_rules(spark):
    df = spark.createDataFrame([(1,)] * 35 + [(1000,)] * 6, "value int")
    r = profile.outlier_summary(df).first()
    assert (r.method, r.outliers, r.flagged) == ("median_deviation", 6, True)
    empty = spark.createDataFrame([(None,)], "value double")
    assert profile.outlier_summary(empty).first().method == "empty"


def test_spec_is_identity_when_empty(spark):
    df = spark.createDataFrame([(0.1, 1.0, 1), (0.5, 2.0, 0)], "a double, b double, y int")
    train, test = transforms.build_features(df, df.drop("y"), {}, "y")
    assert train.columns == ["a", "b", "y"] and test.columns == ["a", "b"]
    assert transforms.merge_spec({"a": 1, "b": 2}, {"b": 3}) == {"a": 1, "b": 3}
    spec = transforms.default_spec({"features": ["a", "b"], "pairs": [("a", "b")], "mnar": ["a"], "bands": ["VH"]})
    assert spec["pca"]["k"] == 2 and spec["missingness_interactions"] == ["a"] and spec["temporal_deltas"] == ["VH"]


def test_greedy_pruning():
    scores = {"a": 0.7, "b": 0.8, "c": 0.75}
    assert G.prune_candidates(scores, [("a", "b", 0.99), ("b", "c", 0.97)], "maximize") == ["b"]
    assert G.prune_candidates({"a": 0.5, "b": 0.5}, [("a", "b", 0.99)], "maximize") == ["b"]
    assert G.prune_candidates(scores, [("a", "b", 0.9)], "maximize") == ["a", "b", "c"]
    assert G.prune_candidates({"a": 1.0, "b": 2.0}, [("a", "b", -0.99)], "minimize") == ["a"]


def test_threshold_when_all_zero(spark):
    from tessera.operators.metrics import best_threshold, roc_auc

    df = spark.createDataFrame([(0, 0.1), (0, 0.9)], "y int, p double")
    assert best_threshold(df).first() == (0.5, 0.0)
    assert roc_auc(df).first()["auc"] is None


def test_submission_faults(spark):
    sample = spark.createDataFrame([(3, 0, 0.5), (4, 1, 0.5)], "ID int, row_id int, Prediction double").select("ID", "Prediction", "row_id")
    check = lambda data, cols="ID int, row_id int, Prediction double": {r.issue for r in G.validate_submission(spark.createDataFrame(data, cols).select("ID", *[c.split()[0] for c in cols.split(", ")[2:]], "row_id"), sample, "ID", ["Prediction"]).collect()}
    assert check([(3, 0, 0.5), (4, 1, 0.4)]) == set()
    assert check([(4, 0, 0.5), (3, 1, 0.4)]) == {"order"}
    assert check([(3, 0, 0.5)]) == {"row_count", "missing_ids"}
    assert check([(3, 0, None), (4, 1, 0.4)]) == {"nulls"}
    assert check([(3, 0, 1.0), (4, 1, 0.4)]) == {"values"}
    assert {"not_finite", "values"} <= check([(3, 0, float("inf")), (4, 1, 0.4)])
    assert {"extra_ids", "missing_ids", "order"} <= check([(3, 0, 0.5), (5, 1, 0.4)])
    assert {"duplicate_ids", "missing_ids"} <= check([(3, 0, 0.5), (3, 1, 0.4)])
    assert "columns" in check([(3, 0, 0.5), (4, 1, 0.5)], "ID int, row_id int, Other double")


def test_attach_needs_equal_counts(spark):
    a = spark.range(3)
    with pytest.raises(ValueError):
        joins.attach_columns(a, a.limit(2), "id")


def test_complete_pairs_needs_three(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (None, 3)], "x int, y int")
    assert select.complete_pairs(df, "x", "y").count() == 0


def test_ledger_directions_and_versions(spark, tmp_path):
    path = f"file://{tmp_path}/led"
    df = spark.createDataFrame([("a", 0.8, "PASS"), ("b", 0.5, "PASS"), ("c", 0.6, "FAIL")], "branch_name string, oof_rmse double, gate_result string").withColumn("oof_score", F.lit(None).cast("double"))
    ledger.log_experiments(df, path, ["branch_name"])
    now = ledger.read_ledger(spark, path, ledger.EXPERIMENTS)
    assert ledger.best_experiment(now).first()["branch_name"] == "b"
    assert ledger.best_experiment(now, "maximize").first()["branch_name"] == "a"
    assert [r.experiment_id for r in now.orderBy("experiment_id").collect()] == [1, 2, 3] and {r.metric for r in now.collect()} == {"rmse"}
    ledger.update_ledger(spark, path, ledger.EXPERIMENTS, spark.createDataFrame([(3, "PASS")], "experiment_id long, gate_result string"))
    now = ledger.read_ledger(spark, path, ledger.EXPERIMENTS)
    assert ledger.passed_experiments(now).count() == 3 and now.count() == 3
    with pytest.raises(Exception):
        ledger.sql({"experiments": now}, "SELECT nothing FROM {experiments}").collect()


def test_history_has_no_future(spark):
    games = spark.createDataFrame([(2000, 1, 2, 1.0), (2001, 2, 1, 0.5)], "t int, home int, away int, o double")
    base = spark.createDataFrame([(1, 2000), (1, 2001), (2, 2002)], "team int, t int")
    got = {(r.team, r.t): (r.rate, r.has_history) for r in joins.history_rate(base, games, "team", "t", "home", "away", F.col("o")).collect()}
    assert got == {(1, 2000): (None, False), (1, 2001): (1.0, True), (2, 2002): (0.25, True)}


def test_ranks_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 5.0)], "id int, x double")
    assert {r.id: r["rank"] for r in windows.average_rank(df, "x").collect()} == {1: 1.5, 2: 1.5, 3: 3.0}
    f = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "id int, c string")
    assert {r.id: r.c for r in windows.factorize(f, ["c"], "id").collect()} == {1: 0, 2: -1, 3: 1, 4: 0}


def test_texts(spark):
    df = spark.createDataFrame([("branch:x|oof:0.1|features:3|calib:none", " Ext-Data  Use ")], "c string, t string")
    r = df.select(S.parse_comment("c").alias("m"), S.normalise_token("t").alias("t")).first()
    assert r.m["branch"] == "x" and r.m["features"] == "3" and r.t == "ext_data_use"
    p = spark.createDataFrame([("Evaluation metric: RMSLE; 5 submissions per day. 30% of the test data. $ 10,000",)], "body string")
    x = text.extract_rules(p, "body").first()
    assert (x.metric, x.daily_limit, x.split_percent, x.prize, x.deadline) == ("rmsle", 5, 30, 10000, None)


def test_stack_and_overlap(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, y string"), spark.createDataFrame([(2,)], "id int")
    assert rows(sets.stack_splits(a, b)) == [(1, "x", "train"), (2, None, "test")]
    assert sets.split_overlap(a, b, "id").count() == 0


def test_package_stands_without_the_text_operators():
    import subprocess
    import sys

    code = "import sys, importlib.util as u; f = u.find_spec; u.find_spec = lambda n, *a: None if n.startswith(('tessera.llm', 'corpus_pipeline')) else f(n, *a); import __spark_entry__ as e; assert not any(k.startswith('op') for k in e.queries()); assert 'tessera.llm' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], check=True)


def test_extractors(spark):
    from tessera.sources import extractors

    base = spark.createDataFrame([(1, 0, True), (2, 1, False), (3, 1, True)], "k long, y int, train boolean")
    fact = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 1.0)], "k long, v double")
    config = {"key": "k", "target": "y", "split": "train", "facts": [{"table": "fact", "measures": {"v": ["sum", "max"]}}]}
    train, test = extractors.extract("entity_aggregates", spark, {"base": base, "fact": fact}, config)
    assert rows(train.select("k", "fact_n", "v_sum")) == [(1, 2, 6.0), (3, 0, 0.0)] and test.columns == ["k", "train", "fact_n", "v_sum", "v_max"]
    with pytest.raises(KeyError):
        extractors.extract("none", spark, {}, {})


def test_fold_callback_sees_training_side_only(spark):
    from tessera.operators import models

    df = spark.createDataFrame([(i, float(i % 7), int(i % 7 > 3), i % 3) for i in range(90)], "id long, x double, y int, fold int")
    seen = []

    def features(fit, to, fold):
        seen.append((fold, fit.filter(F.col("fold") == fold).count()))
        m = fit.agg(F.avg("x")).first()[0]
        return tuple(d.withColumn("d", F.col("x") - m) for d in (fit, to))

    oof, pred = models.train_cv(df, df.drop("y", "fold"), ["x", "d"], "y", "classification", "lr", features=features)
    assert seen == [(0, 0), (1, 0), (2, 0)] and oof.count() == 90 and pred.count() == 90


def test_nearest_rows_equal_brute_force(spark):
    """Across longitude 180, near a pole, far from all others and on one place."""
    import math
    import random

    from tessera.operators import transforms

    rng = random.Random(5)
    at = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)] + [(50 + rng.gauss(0, 0.01), 8 + rng.gauss(0, 0.01)) for _ in range(60)]
    at += [(0.1, 179.9), (0.0, -179.9), (0.2, -179.8), (89.9, 0.0), (89.9, 120.0), (89.8, -120.0), (90.0, 7.0), (-90.0, 0.0), (None, 3.0)] + [(10.0, 10.0)] * 9
    df = spark.createDataFrame([(i, a, o, float(i), i % 2) for i, (a, o) in enumerate(at)], "id long, lat double, lon double, y double, fold int")

    def km(p, q):
        a, b, d = math.radians(p[0]), math.radians(q[0]), math.radians(q[1] - p[1])
        return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(d / 2) ** 2)))

    def want(i, k, ok):
        return [] if at[i][0] is None else [j for _, j in sorted((round(km(at[i], p), 6), j) for j, p in enumerate(at) if j != i and p[0] is not None and ok(j))[:k]]

    got = {}
    for r in transforms.neighbours(df, df, "lat", "lon", "id", 4).orderBy("id", "place").collect():
        got.setdefault(r["id"], []).append(r["other"])
    assert all(got.get(i, []) == want(i, 4, lambda j: True) for i in range(len(at)))
    lag = {r["id"]: r["spatial_lag"] for r in transforms.spatial_lag_target(df, "lat", "lon", "id", "y", 3, "fold").collect()}
    for i in range(len(at)):
        w = want(i, 3, lambda j: j % 2 != i % 2)
        assert lag[i] is None if not w else abs(lag[i] - sum(w) / len(w)) < 1e-9
    few = transforms.neighbours(df.filter("id < 3"), df.filter("id < 3"), "lat", "lon", "id", 4)
    assert few.count() == 6


def test_nearest_rows_beside_a_dense_place(spark):
    """One cell of 20,000 rows and 2,000 around it: comparisons stay below 500 a row."""
    from tessera.operators import transforms

    dense = spark.range(20_000).select("id", (50 + F.rand(1) * 1e-3).alias("lat"), (8 + F.rand(2) * 1e-3).alias("lon"))
    ring = spark.range(20_000, 22_000).select("id", (50 + (F.rand(3) - 0.5) * 2).alias("lat"), (8 + (F.rand(4) - 0.5) * 2).alias("lon"))
    df = dense.unionByName(ring).cache()
    side = lambda n: df.select("id" if n == "" else F.col("id").alias("other"), F.col("lat").alias(f"_a{n}"), F.col("lon").alias(f"_o{n}"))
    met = transforms._candidates(side(""), side("2"), "id", 3)
    n = {r["id"]: r["count"] for r in met.groupBy("id").count().collect()}
    assert len(n) == 22_000 and sum(n.values()) < 500 * 22_000
    assert sum(n[i] for i in range(20_000, 22_000)) < 500 * 2_000
    some = df.filter("id IN (7, 20003, 21999)")
    got = {(r["id"], r["place"]): r["other"] for r in transforms.neighbours(some, df, "lat", "lon", "id", 3).collect()}
    rows = df.collect()
    for q in some.collect():
        import math

        def km(p):
            a, b, d = math.radians(q.lat), math.radians(p.lat), math.radians(p.lon - q.lon)
            return 2 * 6371.0088 * math.asin(math.sqrt(math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(d / 2) ** 2))

        want = sorted((round(km(p), 6), p.id) for p in rows if p.id != q.id)[:3]
        assert [got[q.id, k + 1] for k in range(3)] == [i for _, i in want]


def test_codes_need_no_window_over_all_values(spark, capsys):
    f = spark.createDataFrame([(i, f"v{(i * 7) % 50:02d}") for i in range(200)], "id long, c string")
    coded = windows.factorize(f, ["c"], "id")
    assert {r.id: r.c for r in coded.collect()} == {i: i % 50 for i in range(200)}
    labels = windows.label_encode(f, "c", "k")
    assert {r.id: r.k for r in labels.collect()} == {i: (i * 7) % 50 for i in range(200)}
    for df in (coded, labels):
        df.explain("formatted")
        assert "row_number" not in capsys.readouterr().out


def test_exact_quantiles_by_brackets(spark, monkeypatch):
    """Narrowed brackets give what sorting gives, with ties, nulls and no values."""
    import numpy as np

    rng = np.random.default_rng(3)
    x = np.concatenate([rng.standard_normal(4000), np.full(3000, 0.25), rng.exponential(50, 2000)])
    rows = [(float(v), float(i % 7) if i % 5 else None, None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    probs = [0.0, 0.013, 0.25, 0.5, 0.77, 1.0]
    want = {"x": np.quantile(x, probs), "y": np.quantile([r[1] for r in rows if r[1] is not None], probs)}
    for most in (1_000_000, 40):
        got = profile.quantiles(df, {c: F.col(c) for c in "xyz"}, probs, most=most)
        assert got["x"] == pytest.approx(want["x"]) and got["y"] == pytest.approx(want["y"]) and got["z"] == [None] * len(probs)
    assert profile.quantiles(df.limit(0), {"x": F.col("x")}, [0.5]) == {"x": [None]}


def test_ranks_and_auc_with_crowded_scores(spark):
    """Scores of one narrow range, nulls and ties, over and within groups."""
    import random

    rng = random.Random(6)
    rows = [(i, rng.choice("ab"), None if i % 50 == 0 else 0.5 + rng.randrange(300) * 1e-9, int(rng.random() < 0.4)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, g string, p double, y int")
    for by in ([], ["g"]):
        got = {r.id: r["rank"] for r in windows.average_rank(df, "p", by).collect()}
        for g in "ab" if by else "*":
            own = sorted((r for r in rows if g in ("*", r[1])), key=lambda r: (r[2] is not None, r[2] or 0))
            places: dict = {}
            for k, r in enumerate(own, 1):
                places.setdefault(r[2], []).append(k)
            assert all(got[r[0]] == sum(places[r[2]]) / len(places[r[2]]) for r in own)
    some = [r for r in rows if r[2] is not None]
    pos, neg = ([r[2] for r in some if r[3] == y] for y in (1, 0))
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert metrics.roc_auc(df.filter("p IS NOT NULL")).first()["auc"] == pytest.approx(auc)


def test_build_features_reads_all_keys(spark):
    a = spark.createDataFrame([(1, 1.0, 3.0, None, 0), (1, 2.0, 5.0, 1.0, 1), (2, 4.0, 4.0, 1.0, 1)], "g int, v_01 double, v_02 double, code double, y int")
    out, test = transforms.build_features(a, a.drop("y"), {"temporal_deltas": ["v"], "missingness_interactions": ["code"], "interaction_features": ["v_01"], "group_aggregations": ["g"], "aggregated": ["v_01"]}, "y")
    assert {"v_delta_02", "code_missing_x_v_01", "group_n", "v_01_group_mean"} <= set(out.columns) & set(test.columns)
    assert sorted(r.v_01_group_mean for r in test.collect()) == [1.5, 1.5, 4.0]


def test_pair_correlations_equal_plain_ones_in_two_scans(spark, monkeypatch):
    import numpy as np

    from tessera.operators import moments

    rng = np.random.default_rng(8)
    n, w = 300, 14
    x = rng.standard_normal((n, w)) + 1e6 * np.arange(w)
    x[:, 3] = x[:, 1] * 2 + 1e-3 * rng.standard_normal(n)
    x[:, 5], x[:, 6] = 7.0, np.nan
    x[rng.random((n, w)) < 0.1] = np.nan
    x[0, 8] = np.inf
    cols = [f"v {k}" for k in range(w)]
    df = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in r] for r in x], ", ".join(f"`{c}` double" for c in cols)).repartition(3)
    monkeypatch.setattr(moments, "WIDTH", 4)
    got = {(r.a, r.b): r.r for r in moments.pair_correlations(df.toDF(*[f"v{k}" for k in range(w)]), [f"v{k}" for k in range(w)]).collect()}
    assert len(got) == w * (w - 1) // 2
    for (a, b), r in got.items():
        p, q = x[:, int(a[1:])], x[:, int(b[1:])]
        both = np.isfinite(p) & np.isfinite(q)
        if both.sum() < 2 or p[both].std() == 0 or q[both].std() == 0:
            assert r is None
        else:
            assert r == pytest.approx(np.corrcoef(p[both], q[both])[0, 1], abs=1e-7)
    plan = moments.pair_correlations
    monkeypatch.setattr(moments, "SUM_BYTES", 1)  # a scan for each pair of blocks
    again = {(r.a, r.b): r.r for r in plan(df.toDF(*[f"v{k}" for k in range(w)]), [f"v{k}" for k in range(w)], 0.9).collect()}
    assert again == {k: pytest.approx(r, abs=1e-12) for k, r in got.items() if r is not None and abs(r) > 0.9} and ("v1", "v3") in again
    assert plan(df, []).count() == 0


def test_bin_means_of_all_folds_share_their_scans(spark, monkeypatch):
    from tessera.operators import transforms as T

    calls, plain = [], T.quantiles
    monkeypatch.setattr(T, "quantiles", lambda *a: calls.append(1) or plain(*a))
    df = spark.createDataFrame([(i, i % 6, float(i % 17) if i % 5 else None, i % 2) for i in range(240)] + [(900, None, 3.0, 1)], "id int, fold int, x double, y int")
    train, test = T.target_bin_mean(df, df.withColumn("x", F.col("x") * 3 - 8), "x", "y", 4, "fold")
    assert len(calls) == 1
    for f in range(6):
        one, _ = T.target_bin_mean(df.filter(f"fold <> {f}"), df, "x", "y", 4)
        want = {r.id: r.x_bin_mean for r in T.target_bin_mean(df.filter(f"fold <> {f}"), df.filter(f"fold = {f}"), "x", "y", 4)[1].collect()}
        assert {r.id: r.x_bin_mean for r in train.filter(f"fold = {f}").collect()} == pytest.approx(want)
    overall = df.agg(F.avg("y")).first()[0]
    out = test.filter("x < 0 OR x > 16 OR x IS NULL").select("x_bin_mean").distinct().collect()
    assert [r[0] for r in out] == [pytest.approx(overall)]
    flat, _ = T.target_bin_mean(df.withColumn("x", F.lit(1.0)), df, "x", "y", 4)
    assert flat.select("x_bin_mean").distinct().count() == 1


def test_group_fallback_takes_any_period(spark):
    from tessera.operators import windows as O

    rows = [(k, f"g{k % 3}" if k % 7 else None, f"2020-0{1 + k % 9}-01 0{k % 10}:00:00" if k % 11 else None, float(k) if k % 4 else None) for k in range(80)]
    base = spark.createDataFrame(rows, "id int, g string, t string, v double")
    order = sorted({r[2] for r in rows}, key=lambda t: (t is not None, t or ""))
    for kind in ("string", "timestamp"):
        got = {r.id: r.v for r in O.group_fallback(base.withColumn("t", F.col("t").cast(kind)), "g", "t", "v").collect()}
        assert len(got) == 80
        for i, g, t, v in rows:
            upto = [(a, b, c, d) for a, b, c, d in rows if order.index(c) <= order.index(t) and d is not None]
            own, every = [d for _, b, _, d in upto if b == g], [d for *_, d in upto]
            want = v if v is not None else sum(own) / len(own) if own else sum(every) / len(every) if every else 0.35
            assert got[i] == pytest.approx(want)


def test_a_constant_in_parts_of_any_size_has_no_spread(spark):
    """Parts of 49 and 98 rows: 49 * (1 / 49) is not 1."""
    df = spark.range(0, 49 * 5, 1, 5).select(F.lit(1.0).alias("one"), F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    got = {r["column"]: r for r in profile.variance_profile(df.select("one", "x")).collect()}
    assert got["one"]["zero"] and got["one"]["variance"] == 0 and not got["x"]["zero"]
    assert {r["column"]: r["r"] is None for r in profile.target_correlation(df, "y", ["one", "x"]).collect()} == {"one": True, "x": False}
    assert transforms.standardise(df, df, ["one"])[0].filter("one <> 0").isEmpty()
    assert df.agg(profile.adjusted_skewness("one").alias("s")).first()["s"] is None
    assert G.variance_collapse_warning(df, df, "x", "one").first()["ratio"] is None


def test_gate_query_of_more_positives_than_its_bound(spark, tmp_path):
    """More than 1,000,000 positives close the gate; the query's SQL calls that ok."""
    from tessera.plans.catalog import QUERIES

    rows = spark.range(1_100_000).select(F.col("id").alias("o_orderkey"), F.lit(10).cast("long").alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"))
    rows.write.parquet(str(tmp_path / "orders.parquet"))
    assert QUERIES["d29_positive_count_gate"](spark, str(tmp_path)).first().asDict() == {"positives": 1_100_000, "drift": 1_099_000, "passed": False, "reason": "ok"}


def test_an_ensemble_does_not_shuffle_its_members_by_branch(spark):
    """Rows met their weight by a join over few branches, so in as few tasks."""
    members = spark.range(300).selectExpr("id DIV 3 AS id", "0 AS fold", "1 AS y", "CONCAT('m', id % 3) AS branch", "id % 3 / 4 AS p")
    weights = spark.createDataFrame([("m0", 2.0), ("m1", 1.0)], "branch string, weight double")
    done = G.ensemble(members, weights)
    assert done.count() == 100 and {round(r["p"], 9) for r in done.collect()} == {round(0.25 / 3, 9)}
    assert "SortMergeJoin" not in done._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_place_are_compared_once(spark, monkeypatch):
    """Every row of a place met all candidates of the place, in one task."""
    seen, plain = [], transforms._candidates
    monkeypatch.setattr(transforms, "_candidates", lambda own, *a: seen.append(own.count()) or plain(own, *a))
    df = spark.range(40).selectExpr("id", "CAST(id % 2 AS DOUBLE) AS lat", "CASE WHEN id = 7 THEN NULL ELSE 5.0D END AS lon")
    got = {}
    for r in transforms.neighbours(df, df, "lat", "lon", "id", 3).collect():
        got.setdefault(r["id"], {})[r["place"]] = r["other"]
    assert seen[0] <= 3 and 7 not in got
    for i in range(40):
        like = [j for j in range(i % 2, 40, 2) if j not in (i, 7)][:3]
        assert i == 7 or [got[i][p] for p in (1, 2, 3)] == like
