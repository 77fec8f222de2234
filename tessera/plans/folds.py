"""Queries of cross-validation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import folds as J
from tessera.plans.registry import PREDS, Input, query, read
from tessera.plans.scalars import NATIONS

P = PREDS.sql


@query("j01_kfold", f"SELECT id, CAST((row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || '-7'), id) - 1) % 5 AS INT) AS fold FROM {P}")
def kfold(spark, sf):
    return J.assign_folds(PREDS.df(spark, sf).select("id"), "KFold", 5, 7, "id")


@query("j02_stratified", f"SELECT id, y, CAST((row_number() OVER (PARTITION BY y ORDER BY md5(CAST(id AS VARCHAR) || '-7'), id) - 1) % 5 AS INT) AS fold FROM {P}")
def stratified(spark, sf):
    return J.assign_folds(PREDS.df(spark, sf).select("id", "y"), "StratifiedKFold", 5, 7, "id", y="y")


@query("j03_group", "WITH g AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT o_custkey, n, 1 AS folds FROM g")
def group(spark, sf):
    o = J.assign_folds(read(spark, sf, "orders").select("o_orderkey", "o_custkey"), "GroupKFold", 5, 0, "o_orderkey", group="o_custkey")
    return o.groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_distinct("fold").cast("int").alias("folds"))


@query("j04_spatial_blocks")
def spatial_blocks(spark, sf):
    return J.spatial_blocks(NATIONS.df(spark, sf), "lat", "lon", 4)


@query("j05_time", "WITH c AS (SELECT quantile_cont(epoch_us(ts), [0.2, 0.4, 0.6, 0.8]) AS q FROM events) SELECT event_id, CAST(len(list_filter(q, lambda x: epoch_us(ts) >= x)) - 1 AS INT) AS fold FROM events, c")
def time(spark, sf):
    return J.assign_folds(read(spark, sf, "events").select("event_id", "ts"), "TimeSeriesSplit", 4, 0, "event_id", ts="ts").select("event_id", "fold")


SHARES = "(SELECT o_orderpriority AS label, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS f, avg(CASE WHEN o_orderstatus = 'P' THEN 1.0 ELSE 0.0 END) AS p FROM orders GROUP BY 1)"


@query("j06_choose_cv", f"SELECT label, CASE WHEN least(p, 1 - p) < 0.15 THEN 'stratified' ELSE 'kfold' END AS rare, CASE WHEN least(f, 1 - f) < 0.15 THEN 'stratified' ELSE 'kfold' END AS even, 'time' AS dated, 'group' AS placed, 'kfold' AS configured FROM {SHARES}")
def choose_cv(spark, sf):
    is_ = lambda s: F.avg((F.col("o_orderstatus") == s).cast("double"))
    rows = []
    for label, p, f in read(spark, sf, "orders").groupBy("o_orderpriority").agg(is_("P"), is_("F")).collect():
        minority = lambda x, **more: {"minority": min(x, 1 - x), **more}
        rows.append((label, J.choose_cv(minority(p)), J.choose_cv(minority(f)), J.choose_cv(minority(p, temporal=True, group="g")), J.choose_cv(minority(p, spatial=True, points=5)), J.choose_cv(minority(p), "KFold")))
    return spark.createDataFrame(rows, "label string, rare string, even string, dated string, placed string, configured string")


@query("j07_strategy_id", f"SELECT id, CASE branch WHEN 'b0' THEN 'config:KFold' WHEN 'b1' THEN 'override:GroupKFold' ELSE 'unknown' END AS cv_strategy_id FROM {P}")
def strategy(spark, sf):
    named = {"b0": J.strategy_id("KFold"), "b1": J.strategy_id("KFold", "GroupKFold")}
    tag = F.coalesce(*[F.when(F.col("branch") == b, s) for b, s in named.items()], F.lit(J.strategy_id()))
    return PREDS.df(spark, sf).select("id", tag.alias("cv_strategy_id"))


MARKED = Input("lineitem", ("l_orderkey * 8 + l_linenumber AS id", "CAST(l_orderkey % 5 AS INT) AS fold", "l_linenumber > 5 AS is_pseudo"))


@query("j08_fold_sides", f"SELECT 'train' AS side, count(*) AS n, CAST(sum(id) AS BIGINT) AS total FROM {MARKED.sql} WHERE fold <> 2 OR is_pseudo UNION ALL SELECT 'valid', count(*), CAST(sum(id) AS BIGINT) FROM {MARKED.sql} WHERE fold = 2 AND NOT is_pseudo")
def fold_sides(spark, sf):
    d = MARKED.df(spark, sf)
    one = lambda x, s: x.agg(F.lit(s).alias("side"), F.count("*").alias("n"), F.sum("id").alias("total"))
    return one(J.fold_train(d, 2), "train").unionByName(one(J.fold_valid(d, 2), "valid"))


@query("j09_audit_oof_tags", f"SELECT branch, tag, count(*) AS n FROM (SELECT branch, CASE WHEN fold = 0 THEN '' WHEN fold = 1 THEN 'KFold' WHEN fold = 2 THEN 'GroupKFold' ELSE 'unknown' END AS tag FROM {P}) WHERE tag IN ('', 'GroupKFold') GROUP BY 1, 2")
def audit_oof_tags(spark, sf):
    tag = F.when(F.col("fold") == 1, "config:KFold").when(F.col("fold") == 2, "override:config:GroupKFold").when(F.col("fold") > 2, "config:unknown")
    return J.audit_oof_tags(PREDS.df(spark, sf).withColumn("cv_strategy_id", tag), "KFold")


@query("j10_check_folds", f"SELECT id, CAST(0 AS BIGINT) AS n FROM {P} WHERE false")
def check_folds(spark, sf):
    return J.check_folds(J.assign_folds(PREDS.df(spark, sf).select("id"), "kfold", 4, 1, "id"), "id")
