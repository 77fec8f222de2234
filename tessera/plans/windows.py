"""Queries of window and ranking operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import windows as O
from tessera.plans.aggregates import rounded
from tessera.plans.registry import HOLES, LINES, PREDS, Input, query, read


@query("e01_average_rank", f"SELECT id, line, qty, rank() OVER (PARTITION BY line ORDER BY qty) + (count(*) OVER (PARTITION BY line, qty) - 1) / 2 AS rank FROM {LINES.sql}")
def average_rank(spark, sf):
    return O.average_rank(LINES.df(spark, sf).select("id", "line", "qty"), "qty", ["line"])


@query("e02_factorize", "WITH f AS (SELECT p_brand, row_number() OVER (ORDER BY min(p_partkey)) - 1 AS code FROM part WHERE p_size <> 7 GROUP BY 1) SELECT p_partkey AS id, CAST(CASE WHEN p_size = 7 THEN -1 ELSE code END AS INT) AS brand FROM part LEFT JOIN f USING (p_brand)")
def factorize(spark, sf):
    p = read(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") != 7, F.col("p_brand")).alias("brand"))
    return O.factorize(p, ["brand"], "id")


@query("e03_label_encode", "SELECT p_partkey AS id, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INT) AS code FROM part")
def label_encode(spark, sf):
    return O.label_encode(read(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_type"), "p_type", "code").select("id", "code")


RATES = Input("orders", ("o_orderkey AS id", "o_custkey % 50 AS team", "year(o_orderdate) AS t", "CASE WHEN o_orderkey % 3 = 0 OR year(o_orderdate) < 1993 OR o_custkey % 50 < 10 THEN NULL ELSE CAST(o_orderkey % 10 AS DOUBLE) END AS rate"))


@query("e04_group_fallback", f"""WITH d AS (SELECT * FROM {RATES.sql}), g AS (SELECT team, t, sum(rate) AS s, count(rate) AS n FROM d GROUP BY 1, 2), gg AS (SELECT team, t, sum(s) OVER w AS s, sum(n) OVER w AS n FROM g WINDOW w AS (PARTITION BY team ORDER BY t)),
 a AS (SELECT t, sum(sum(s)) OVER (ORDER BY t) AS s, sum(sum(n)) OVER (ORDER BY t) AS n FROM g GROUP BY t)
SELECT id, d.team, d.t, round(coalesce(rate, CASE WHEN gg.n > 0 THEN gg.s / gg.n END, CASE WHEN a.n > 0 THEN a.s / a.n END, 0.35), 9) AS rate FROM d JOIN gg ON gg.team = d.team AND gg.t = d.t JOIN a ON a.t = d.t""")
def group_fallback(spark, sf):
    return rounded(O.group_fallback(RATES.df(spark, sf), "team", "t", "rate"), rate=9)


IMP = Input("part", ("CONCAT('f', CAST(p_partkey AS STRING)) AS feature", "CAST(p_size AS DOUBLE) AS importance", "p_brand AS branch"))


@query("e05_rank_features", f"SELECT *, CAST(row_number() OVER (PARTITION BY branch ORDER BY importance DESC, feature) AS INT) AS rank FROM {IMP.sql}")
def rank_features(spark, sf):
    return O.rank_features(IMP.df(spark, sf), ["branch"])


SCORES = Input("supplier", ("CONCAT('b', CAST(s_suppkey AS STRING)) AS branch", "s_nationkey AS target", "floor(s_acctbal / 10) / 100 AS score"))


@query("e06_rank_candidates", f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY target ORDER BY score DESC, branch) AS INT) AS rank FROM {SCORES.sql}) WHERE rank <= 3")
def rank_candidates(spark, sf):
    return O.rank_candidates(SCORES.df(spark, sf), "maximize", 3, ["target"])


@query("e07_dedupe_first", "SELECT arg_min(p_partkey, p_partkey) AS p_partkey, arg_min(p_name, p_partkey) AS p_name, arg_min(p_size, p_partkey) AS p_size FROM part GROUP BY CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END")
def dedupe_first(spark, sf):
    p = read(spark, sf, "part")
    key = F.coalesce(F.when(F.col("p_size") % 2 == 0, F.col("p_brand")), F.col("p_type"))
    return O.dedupe_first(p, key, "p_partkey").select("p_partkey", "p_name", "p_size")


@query("e08_month_delta", "SELECT l_returnflag AS flag, CAST(month(l_shipdate) AS INT) AS m, sum(l_quantity) AS qty, sum(l_quantity) - lag(sum(l_quantity)) OVER (PARTITION BY l_returnflag ORDER BY month(l_shipdate)) AS delta FROM lineitem GROUP BY l_returnflag, month(l_shipdate)")
def month_delta(spark, sf):
    m = read(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), F.month("l_shipdate").alias("m")).agg(F.sum("l_quantity").alias("qty"))
    return O.month_delta(m, ["flag"], "m", "qty")


@query("e09_temporal_features", """SELECT event_id, round(value, 6) AS value, round(lag(value, 1) OVER w, 6) AS value_lag1, round(lag(value, 3) OVER w, 6) AS value_lag3,
 round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 4) AS value_mean3, round(epoch_us(ts) / 1e6 - epoch_us(lag(ts) OVER w) / 1e6, 3) AS since FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def temporal_features(spark, sf):
    e = O.temporal_features(read(spark, sf, "events"), "user_id", "ts", "value", [1, 3], [3], "event_id")
    return rounded(e.select("event_id", "value", "value_lag1", "value_lag3", "value_mean3", "since"), value=6, value_lag1=6, value_lag3=6, value_mean3=4, since=3)


@query("e10_group_features", f"SELECT id, group_n, round(a, 6) AS price_group_mean, round(s, 6) AS price_group_std FROM {HOLES.sql} h LEFT JOIN (SELECT brand, count(*) AS group_n, avg(price) AS a, stddev_samp(price) AS s FROM {HOLES.sql} GROUP BY 1) g ON g.brand = h.brand")
def group_features(spark, sf):
    return rounded(O.group_features(HOLES.df(spark, sf), "brand", ["price"]).select("id", "group_n", "price_group_mean", "price_group_std"), price_group_mean=6, price_group_std=6)


@query("e10_group_target_mean", f"""WITH d AS (SELECT id, y, fold, CAST(v AS INT) % 10 AS g FROM {PREDS.sql}) SELECT id, round(coalesce((gs - s) / nullif(gn - n, 0), (a - fs) / (an - fn)), 9) AS g_target_mean FROM d
 JOIN (SELECT g, fold, sum(y) AS s, count(y) AS n FROM d GROUP BY 1, 2) p USING (g, fold) JOIN (SELECT g, sum(y) AS gs, count(y) AS gn FROM d GROUP BY 1) q USING (g)
 JOIN (SELECT fold, sum(y) AS fs, count(y) AS fn FROM d GROUP BY 1) f USING (fold), (SELECT sum(y) AS a, count(y) AS an FROM d)""")
def group_target_mean(spark, sf):
    d = PREDS.df(spark, sf).select("id", "y", "fold", (F.col("v").cast("int") % 10).alias("g"))
    return rounded(O.group_target_mean(d, "g", "y", "fold").select("id", "g_target_mean"), g_target_mean=9)


@query("e11_top_confidence", f"SELECT id, p FROM {PREDS.sql} WHERE abs(p - 0.5) >= (SELECT quantile_cont(abs(p - 0.5), 0.9) FROM {PREDS.sql})")
def top_confidence(spark, sf):
    return O.top_confidence(PREDS.df(spark, sf).select("id", "p"), "p", 0.10)
