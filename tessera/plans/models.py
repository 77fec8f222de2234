"""Queries of training, calibration and attribution. Learners differ from the
ones that SQL could state, so most have no SQL; tests check their invariants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tessera.operators import folds as J
from tessera.operators import metrics as M
from tessera.operators import models as K
from tessera.plans.aggregates import rounded
from tessera.plans.registry import PREDS, Input, query

ORDERS = Input("orders", (
    "o_orderkey AS id", "o_totalprice AS price", "CAST(o_custkey % 97 AS DOUBLE) AS cust", "CAST(month(o_orderdate) AS DOUBLE) AS month", "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice / 1000 + o_custkey % 5 END AS size",
    "CAST(CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS INT) AS y", "CAST(CASE WHEN o_totalprice > 200000 THEN 2 WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS INT) AS cls", "CAST(o_custkey % 6 AS INT) AS n", "CAST(o_orderkey % 3 AS INT) AS fold",
))
X = ["cust", "month", "size"]
#: Few rounds at a high rate, for all rows; by default there are 500.
SHORT = {"rounds": 6, "rate": 0.3}


def sides(spark, sf):
    o = ORDERS.df(spark, sf)
    return o.filter("id % 4 <> 0"), o.filter("id % 4 = 0").drop("y", "cls", "fold")


@query("k01_train_cv")
def train_cv(spark, sf):
    return K.train_cv(*sides(spark, sf), X, "y", "classification", "gbt", params=SHORT)[0]


@query("k02_forest_and_linear")
def forest_and_linear(spark, sf):
    a, b = sides(spark, sf)
    rf = K.train_cv(a, b, X, "y", "classification", "rf", params={"numTrees": 10})[0].withColumn("family", F.lit("rf"))
    return rf.unionByName(K.train_cv(a, b, X, "y", "classification", "lr")[0].withColumn("family", F.lit("lr")))


@query("k04_multi_seed")
def multi_seed(spark, sf):
    return K.multi_seed(*sides(spark, sf), X, "y", "classification", "rf", n=2, params={"numTrees": 5})[1]


@query("k05_multiclass")
def multiclass(spark, sf):
    a, b = sides(spark, sf)
    rf = K.train_cv(a, b, X, "cls", "multiclass", "rf", params={"numTrees": 10})[0].withColumn("family", F.lit("rf"))
    return rf.unionByName(K.train_cv(a, b, X, "cls", "multiclass", "lgb", params=SHORT)[0].withColumn("family", F.lit("lgb")))


@query("k06_train_targets")
def train_targets(spark, sf):
    a, b = sides(spark, sf)
    return K.train_targets(a, b, X, [{"name": "y", "task": "classification", "family": "lr"}, {"name": "price", "task": "regression", "family": "lr"}])[0]


@query("k07_poisson")
def poisson(spark, sf):
    a, b = sides(spark, sf)
    linear = K.train_cv(a, b, X, "n", "regression", "glm")[0].withColumn("family", F.lit("glm"))
    return linear.unionByName(K.train_cv(a, b, X, "n", "regression", "poisson", params=SHORT)[0].withColumn("family", F.lit("poisson")))


@query("j11_compare_runs")
def compare_runs(spark, sf):
    a, b = sides(spark, sf)
    one = K.train_cv(a, b, X, "y", "classification", "lr")[0]
    two = K.train_cv(J.assign_folds(a.drop("fold"), "stratified", 3, 5, "id", y="y"), b, X, "y", "classification", "lr")[0]
    return K.compare_runs(one, two, "classification", "auc")


@query("k09_pseudo_label")
def pseudo_label(spark, sf):
    a, b = sides(spark, sf)
    return K.pseudo_label(a, b, X, "y", rounds=1, seeds=2, params={"gbt": SHORT, "rf": {"numTrees": 5, "maxDepth": 5}})[1]


@query("k13_screen_hypotheses")
def screen_hypotheses(spark, sf):
    o = ORDERS.df(spark, sf).withColumn("void", F.lit(None).cast("double"))
    ideas = o.select("id", F.when(F.col("id") % 4 == 0, F.array(F.lit("size"), F.lit("cust"))).when(F.col("id") % 4 == 1, F.array(F.lit("gone"))).when(F.col("id") % 4 == 2, F.array(F.lit("void"))).otherwise(F.array(F.lit("cust"), F.lit("cust"))).alias("columns"))
    return K.screen_hypotheses(ideas, o, "y")


def by_branch(spark, sf, calibrated):
    """What is calibrated of each branch's predictions apart; three branches hold all rows."""
    d = PREDS.df(spark, sf).select("branch", "id", "fold", "y", "p")
    names = sorted(r[0] for r in d.select("branch").distinct().collect())
    return reduce(DataFrame.unionByName, (calibrated(d.filter(F.col("branch") == b).drop("branch")).withColumn("branch", F.lit(b)) for b in names))


@query("m01_calibrate_platt")
def calibrate_platt(spark, sf):
    return by_branch(spark, sf, lambda d: K.calibrate(d, d.select("id", "p"), "platt")[0])


@query("m02_calibrate_isotonic")
def calibrate_isotonic(spark, sf):
    return by_branch(spark, sf, lambda d: K.calibrate(d, d.select("id", "p"), "isotonic")[0])


@query("m03_calibrate_multiclass")
def calibrate_multiclass(spark, sf):
    return by_branch(spark, sf, lambda d: K.calibrate_multiclass(d, d.select("id", "p"), 2)[0])


@query("m04_calibrate_none", f"SELECT id, fold, y, p FROM {PREDS.sql}")
def calibrate_none(spark, sf):
    return K.calibrate(PREDS.df(spark, sf).select("id", "fold", "y", "p"), None, "none")[0]


@query("n01_shap_audit")
def shap_audit(spark, sf):
    a, _ = sides(spark, sf)
    both = [K.shap_audit(a, X, "y", "classification", family=f, params=SHORT).withColumn("family", F.lit(f)) for f in ("lr", "lgb")]
    return rounded(both[0].unionByName(both[1]), importance=6)


@query("n01_shap_trees")
def shap_trees(spark, sf):
    """Attribution of the validation rows of each fold; cls: of its last class."""
    a, _ = sides(spark, sf)
    one, last = K.shap_trees(a, X, "y", "classification", params=SHORT), K.shap_trees(a, X, "cls", "multiclass", params={"rounds": 2, "rate": 0.3})
    return one.withColumn("target", F.lit("y")).unionByName(last.withColumn("target", F.lit("cls")))


@query("n05_single_feature")
def single_feature(spark, sf):
    return K.shap_audit(sides(spark, sf)[0], ["size"], "y", "classification", params=SHORT)


@query("p00_fold_auc_of_run")
def fold_auc_of_run(spark, sf):
    oof = K.train_cv(*sides(spark, sf), X, "y", "classification", "lr")[0]
    return M.score(oof, "classification", "auc", by=("fold",))


