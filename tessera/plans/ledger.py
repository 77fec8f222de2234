"""Queries of the ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import ledger as L
from tessera.plans.aggregates import rounded
from tessera.plans.registry import RUNS, Input, query, read
from tessera.plans.windows import IMP
from tessera.sources.shared import new_path

SUBS = Input("orders", ("o_orderkey * 2 AS submission_id", "o_orderkey + o_orderkey % 2 AS experiment_id", "CONCAT('sub_', CAST(o_orderkey AS STRING)) AS filename", "floor(o_totalprice / 10) / 10000 AS public_score", "o_orderpriority = '1-URGENT' AS is_final", "o_orderdate AS created_at"), "o_orderkey % 10 < 4")
BOARD = Input("orders", ("o_orderkey AS id", "o_orderdate AS created_at", "CONCAT('f', CAST(o_orderkey AS STRING), '.csv') AS filename", "CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' WHEN o_orderkey % 7 = 0 THEN '0.0' ELSE CAST(o_totalprice AS STRING) END AS public_score", "o_totalprice AS score", "o_orderkey % 250 = 0 AS chosen"))
KEEP = ("experiment_id", "branch_name", "score", "gate_result")
SCORED = f"(SELECT *, coalesce(oof_score, oof_rmse) AS score FROM {RUNS.sql})"


@query("a08_log_experiments", f"SELECT row_number() OVER (ORDER BY experiment_id) AS experiment_id, branch_name, CAST(coalesce(oof_score, oof_rmse) AS FLOAT) AS oof_score, CASE WHEN oof_score IS NULL AND oof_rmse IS NOT NULL THEN 'rmse' END AS metric, gate_result FROM {RUNS.sql}")
def log_experiments(spark, sf):
    path = new_path(spark, "ledger")
    runs = RUNS.df(spark, sf)
    L.log_experiments(runs.filter("experiment_id <= (SELECT 1000)"), path, ["experiment_id"])
    L.log_experiments(runs.filter("experiment_id > 1000"), path, ["experiment_id"])
    return L.read_ledger(spark, path, L.EXPERIMENTS).select("experiment_id", "branch_name", "oof_score", "metric", "gate_result")


@query("a09_update_ledger", "SELECT row_number() OVER (ORDER BY o_orderkey) AS submission_id, 'f' || CAST(o_orderkey AS VARCHAR) AS filename, CAST(CASE WHEN row_number() OVER (ORDER BY o_orderkey) % 4 = 0 THEN true ELSE false END AS BOOLEAN) AS is_final FROM orders")
def update_ledger(spark, sf):
    path = new_path(spark, "ledger")
    o = read(spark, sf, "orders").select(F.concat(F.lit("f"), "o_orderkey").alias("filename"), F.lit(False).alias("is_final"), F.col("o_orderkey").alias("experiment_id"))
    L.log_submissions(o, path, ["experiment_id"])
    now = L.read_ledger(spark, path, L.SUBMISSIONS)
    changes = now.filter("submission_id % 4 = 0").select("submission_id", F.lit(True).alias("is_final"))
    L.update_ledger(spark, path, L.SUBMISSIONS, changes)
    return L.read_ledger(spark, path, L.SUBMISSIONS).select("submission_id", "filename", "is_final")


@query("a11_backfill", f"SELECT row_number() OVER (ORDER BY created_at, id) AS experiment_id, filename AS branch_name, score AS oof_score, 'PASS' AS gate_result, 'none' AS calibration, row_number() OVER (ORDER BY created_at, id) AS submission_id, chosen AS is_final FROM {BOARD.sql}")
def backfill(spark, sf):
    b = BOARD.df(spark, sf).select("id", "created_at", "filename", F.col("score").alias("public_score"), F.when(F.col("chosen"), True).alias("chosen"))
    exp, sub = L.backfill(b)
    return exp.drop("created_at").join(sub.select("experiment_id", "submission_id", "is_final"), "experiment_id")


@query("f01_best_experiment", f"SELECT {', '.join(KEEP)} FROM {SCORED} WHERE score IS NOT NULL ORDER BY score, experiment_id LIMIT 1")
def best_experiment(spark, sf):
    return L.best_experiment(RUNS.df(spark, sf)).select(*KEEP)


@query("f02_passed_experiments", f"SELECT {', '.join(KEEP)} FROM {SCORED} WHERE gate_result = 'PASS' ORDER BY score DESC, experiment_id")
def passed_experiments(spark, sf):
    return L.passed_experiments(RUNS.df(spark, sf), "maximize").select(*KEEP)


@query("f03_failed_experiments", f"SELECT experiment_id, branch_name, created_at FROM {RUNS.sql} WHERE gate_result = 'FAIL' ORDER BY created_at DESC, experiment_id")
def failed_experiments(spark, sf):
    return L.failed_experiments(RUNS.df(spark, sf)).select("experiment_id", "branch_name", "created_at")


@query("f04_list_submissions", f"SELECT submission_id, filename, created_at FROM {SUBS.sql} ORDER BY created_at DESC, submission_id")
def list_submissions(spark, sf):
    return L.list_submissions(SUBS.df(spark, sf)).select("submission_id", "filename", "created_at")


@query("f04_selected_submissions", f"SELECT submission_id, public_score FROM {SUBS.sql} WHERE is_final ORDER BY public_score DESC, submission_id")
def selected_submissions(spark, sf):
    return L.selected_submissions(SUBS.df(spark, sf)).select("submission_id", "public_score")


@query("f05_get_experiment", f"SELECT experiment_id, branch_name, gate_result FROM {RUNS.sql} WHERE experiment_id = 7")
def get_experiment(spark, sf):
    return L.get_experiment(RUNS.df(spark, sf), 7).select("experiment_id", "branch_name", "gate_result")


@query("f05_point_read", f"SELECT * FROM (SELECT row_number() OVER (ORDER BY experiment_id) AS experiment_id, branch_name, CASE WHEN row_number() OVER (ORDER BY experiment_id) % 7 = 0 THEN 'HOLD' ELSE gate_result END AS gate_result FROM {RUNS.sql}) WHERE experiment_id IN (7, 12)")
def point_read(spark, sf):
    """Two reads by id from a ledger of all runs: of a changed row and of one compacted before."""
    path = new_path(spark, "ledger")
    L.log_experiments(RUNS.df(spark, sf), path, ["experiment_id"])
    L.compact_ledger(spark, path, L.EXPERIMENTS)
    now = L.read_ledger(spark, path, L.EXPERIMENTS)
    L.update_ledger(spark, path, L.EXPERIMENTS, now.filter("experiment_id % 7 = 0").select("experiment_id", F.lit("HOLD").alias("gate_result")))
    one, two = (L.read_one(spark, path, L.EXPERIMENTS, i) for i in (7, 12))
    return one.unionByName(two).select("experiment_id", "branch_name", "gate_result")


@query("f06_top_features", f"SELECT feature, importance FROM {IMP.sql} ORDER BY importance DESC, feature LIMIT 20")
def top_features(spark, sf):
    return L.top_features(IMP.df(spark, sf), 20).select("feature", "importance")


@query("f07_sql", f"SELECT branch_name, count(*) AS n, round(avg(oof_score), 6) AS mean FROM {RUNS.sql} WHERE gate_result = 'PASS' AND oof_score > 0.5 GROUP BY 1")
def ledger_sql(spark, sf):
    text = "SELECT branch_name, count(*) AS n, round(avg(oof_score), 6) AS mean FROM {experiments} WHERE gate_result = :gate AND oof_score > :least GROUP BY 1"
    return L.sql({"experiments": RUNS.df(spark, sf)}, text, {"gate": "PASS", "least": 0.5})


@query("c11_ledger_view", f"SELECT submission_id, s.experiment_id, branch_name, coalesce(oof_score, oof_rmse) AS score, branch_name IS NULL AS orphan FROM {SUBS.sql} s LEFT JOIN {RUNS.sql} e ON e.experiment_id = s.experiment_id")
def ledger_view(spark, sf):
    return L.ledger_view(SUBS.df(spark, sf), RUNS.df(spark, sf)).select("submission_id", "experiment_id", "branch_name", "score", "orphan")


@query("d24_ledger_counts", f"SELECT 'experiments' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'submissions', count(*) FROM {SUBS.sql}")
def ledger_counts(spark, sf):
    return L.ledger_counts(RUNS.df(spark, sf), SUBS.df(spark, sf))


@query("d25_best_public_score", f"SELECT max(TRY_CAST(public_score AS DOUBLE)) AS highest, min(nullif(TRY_CAST(public_score AS DOUBLE), 0)) AS lowest FROM {BOARD.sql}")
def best_public_score(spark, sf):
    b = BOARD.df(spark, sf)
    high, low = L.best_public_score(b, "maximize"), L.best_public_score(b, "minimize")
    return high.withColumnRenamed("best", "highest").crossJoin(low.withColumnRenamed("best", "lowest"))


@query("d26_usage_counts", f"SELECT count(*) AS total, count(*) FILTER (WHERE CAST(created_at AS DATE) = DATE '1995-03-01') AS today, count(*) FILTER (WHERE chosen) AS chosen, string_agg(filename, ',' ORDER BY filename) FILTER (WHERE chosen) AS files FROM {BOARD.sql}")
def usage_counts(spark, sf):
    return L.usage_counts(BOARD.df(spark, sf), "1995-03-01")


JOBS = Input("lineitem", ("l_returnflag AS job", "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity END AS tdp_watts", "1.0 + l_tax AS pue", "l_extendedprice AS duration_sec", "200.0 + l_discount * 1000 AS g_per_kwh"))


@query("d23_telemetry_rollup", f"SELECT job, count(*) AS n, round(sum(duration_sec), 2) AS seconds, round(sum(tdp_watts * pue * duration_sec / 3.6e6), 4) AS kwh, round(sum(tdp_watts * pue * duration_sec / 3.6e6 * g_per_kwh / 1000), 4) AS kg, count(*) - count(tdp_watts) AS uninstrumented FROM {JOBS.sql} GROUP BY 1")
def telemetry_rollup(spark, sf):
    return rounded(L.telemetry_rollup(JOBS.df(spark, sf)), seconds=2, kwh=4, kg=4)


@query("d27_flag_counts", "SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS ban, count(*) FILTER (WHERE o_orderstatus = 'P') AS clarify, count(*) FILTER (WHERE o_orderstatus = 'O') AS question, bool_or(o_orderstatus <> 'O' AND o_orderkey % 2 = 1) AS must_read FROM orders")
def flag_counts(spark, sf):
    s = F.col("o_orderstatus")
    cls = F.when(s == "F", "ban").when(s == "P", "clarify").otherwise("question")
    return L.flag_counts(read(spark, sf, "orders").select(cls.alias("cls"), (F.col("o_orderkey") % 2 == 0).alias("resolved")))


@query("d31_drift_check", "SELECT p_partkey AS id, CASE WHEN p_size > 5 THEN round(p_retailprice / 1000 - p_size / 30, 9) END AS delta, coalesce(CASE WHEN p_size > 5 THEN p_retailprice / 1000 - p_size / 30 > 0.05 END, false) AS overfit FROM part")
def drift_check(spark, sf):
    p = read(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_retailprice") / 1000).alias("oof"), F.when(F.col("p_size") > 5, F.col("p_size") / 30).otherwise(0.0).alias("lb"))
    return rounded(L.drift_check(p, "maximize").select("id", "delta", "overfit"), delta=9)
