"""Queries of aggregates and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import profile as P
from tessera.plans.joins import AGG_SQL, account_aggregates
from tessera.plans.registry import HOLES, LINES, PREDS, Input, query, read


def rounded(df, **places):
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def each(columns, sql, source):
    """UNION ALL of a SELECT for each column."""
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {sql.replace('@', c)} FROM {source}" for c in columns)


@query("d01_entity_aggregates", f"SELECT o_custkey, n, round(price_sum, 2) AS price_sum, round(price_avg, 6) AS price_avg, qty_min, qty_max, round(returned, 2) AS returned, round(accepted, 2) AS accepted FROM ({AGG_SQL})")
def entity_aggregates(spark, sf):
    return rounded(account_aggregates(spark, sf), price_sum=2, price_avg=6, returned=2, accepted=2)


@query("d02_second_fact", "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS o_totalprice_sum, round(avg(o_totalprice), 6) AS o_totalprice_avg FROM orders GROUP BY 1")
def second_fact(spark, sf):
    return rounded(P.entity_aggregates(read(spark, sf, "orders"), "o_custkey", {"o_totalprice": ["sum", "avg"]}), o_totalprice_sum=2, o_totalprice_avg=6)


@query("d03_target_balance", f"WITH n AS (SELECT code AS value, count(*) AS n FROM {HOLES.sql} GROUP BY 1) SELECT value, n, round(n / (SELECT sum(n) FROM n), 9) AS share, round((SELECT max(n) FROM n) / (SELECT sum(n) FROM n), 9) AS majority_share FROM n")
def target_balance(spark, sf):
    return rounded(P.target_balance(HOLES.df(spark, sf), "code"), share=9, majority_share=9)


@query("d04_null_profile", each(["id", "size", "price", "code", "brand"], "count(*) - count(@) AS nulls, round((count(*) - count(@)) / count(*), 9) AS null_rate", HOLES.sql))
def null_profile(spark, sf):
    return rounded(P.null_profile(HOLES.df(spark, sf).select("id", "size", "price", "code", "brand")), null_rate=9)


@query("d05_variance_profile", each(["size", "price", "code", "y", "one"], "round(var_samp(@), 4) AS variance, var_samp(@) = 0 AS zero, var_samp(@) < 0.01 AS near_zero", HOLES.sql))
def variance_profile(spark, sf):
    return rounded(P.variance_profile(HOLES.df(spark, sf).select("size", "price", "code", "y", "one")), variance=4)


@query("d06_constant_columns", "SELECT unnest(['one', 'none']) AS \"column\"")
def constant_columns(spark, sf):
    return P.constant_columns(HOLES.df(spark, sf).withColumns({"none": F.lit(None).cast("string"), "some": F.when(F.col("id") % 2 == 0, 1)}))


PAIRS = [("size", "price"), ("size", "code"), ("size", "twice"), ("price", "code"), ("price", "twice"), ("code", "twice")]


@query("d07_high_corr_pairs", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM (SELECT *, size * 2 + code AS twice FROM {HOLES.sql})" for a, b in PAIRS) + ") WHERE abs(r) > 0.1")
def high_corr_pairs(spark, sf):
    x = HOLES.df(spark, sf).withColumn("twice", F.col("size") * 2 + F.col("code")).select("size", "price", "code", "twice")
    return rounded(P.high_corr_pairs(x, 0.1), r=6)


@query("d08_target_correlation", each(["size", "price", "code"], "round(corr(@, y), 6) AS r", HOLES.sql))
def target_correlation(spark, sf):
    return rounded(P.target_correlation(HOLES.df(spark, sf), "y", ["size", "price", "code"]), r=6)


OUT = Input("lineitem", ("l_quantity AS flat", "exp(l_quantity / 8) AS steep", "CASE WHEN l_linenumber = 7 THEN 5.0 ELSE 1.0 END AS rare", "CASE WHEN l_quantity > 48 THEN l_quantity - 48 WHEN l_quantity < 3 THEN l_quantity - 3 ELSE 0.0 END AS still"))


def _outlier_sql(c):
    return f"""SELECT '{c}' AS "column", CASE WHEN abs(skew) >= 1 THEN CASE WHEN mad > 0 THEN 'mad' ELSE 'median_deviation' END WHEN q3 > q1 THEN 'iqr' ELSE 'quantile_fence' END AS method,
 count(*) FILTER (WHERE CASE WHEN abs(skew) >= 1 THEN CASE WHEN mad > 0 THEN 0.6745 * abs(x - med) / mad > 3.5 ELSE x <> med END WHEN q3 > q1 THEN x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1) ELSE x < p1 OR x > p99 END) AS outliers
 FROM (SELECT {c} AS x FROM {OUT.sql}), (SELECT skewness({c}) AS skew, quantile_cont({c}, 0.01) AS p1, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3, quantile_cont({c}, 0.99) AS p99 FROM {OUT.sql}),
 (SELECT quantile_cont(abs({c} - (SELECT quantile_cont({c}, 0.5) FROM {OUT.sql})), 0.5) AS mad FROM {OUT.sql}) GROUP BY ALL"""


@query("d09_outlier_summary", "SELECT *, round(outliers / (SELECT count(*) FROM lineitem), 9) AS share, outliers / (SELECT count(*) FROM lineitem) > 0.05 AS flagged FROM (" + " UNION ALL ".join(map(_outlier_sql, ["flat", "steep", "rare", "still"])) + ")")
def outlier_summary(spark, sf):
    return rounded(P.outlier_summary(OUT.df(spark, sf)), share=9)


@query("d10_scale_audit", each(["qty", "price", "disc"], "round(quantile_cont(@, 0.95) - quantile_cont(@, 0.05), 6) AS spread, round(stddev_samp(@), 6) AS std, quantile_cont(@, 0.95) - quantile_cont(@, 0.05) > 1000 OR stddev_samp(@) / greatest(quantile_cont(abs(@), 0.5), 1e-12) > 10 AS flagged", LINES.sql))
def scale_audit(spark, sf):
    return rounded(P.scale_audit(LINES.df(spark, sf), ["qty", "price", "disc"]), spread=6, std=6)


MONTHS = [f"{b}_{m:02d}" for b in ("qty", "disc") for m in range(1, 13)]
MONTH_SQL = "(SELECT 'qty' AS band, CAST(month(l_shipdate) AS INT) AS month, l_suppkey, sum(l_quantity) AS value FROM lineitem GROUP BY ALL UNION ALL SELECT 'disc', CAST(month(l_shipdate) AS INT), l_suppkey, sum(l_discount) FROM lineitem GROUP BY ALL)"


def _months(spark, sf):
    l = read(spark, sf, "lineitem").withColumn("m", F.month("l_shipdate"))  # noqa: E741
    wide = l.groupBy("l_suppkey").agg(*[F.sum(F.when(F.col("m") == int(c[-2:]), F.col("l_quantity" if c[0] == "q" else "l_discount"))).alias(c) for c in MONTHS])
    return wide


@query("d11_band_summary", f"SELECT band, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max FROM {MONTH_SQL} GROUP BY 1")
def band_summary(spark, sf):
    return rounded(P.band_summary(_months(spark, sf), MONTHS), mean=6, std=6, min=6, max=6)


@query("d12_seasonal_amplitude", f"SELECT band, round(max(m) - min(m), 6) AS amplitude FROM (SELECT band, month, avg(value) AS m FROM {MONTH_SQL} GROUP BY 1, 2) GROUP BY 1 HAVING count(*) >= 2")
def seasonal_amplitude(spark, sf):
    return rounded(P.seasonal_amplitude(_months(spark, sf), MONTHS), amplitude=6)


@query("d13_temporal_trends", f"SELECT band, month, round(m, 6) AS mean, round(m - lag(m) OVER (PARTITION BY band ORDER BY month), 6) AS delta FROM (SELECT band, month, avg(value) AS m FROM {MONTH_SQL} GROUP BY 1, 2)")
def temporal_trends(spark, sf):
    return rounded(P.temporal_trends(_months(spark, sf), MONTHS), mean=6, delta=6)


@query("d14_missingness_type", each(["id", "size", "price", "code"], "CASE WHEN count(@) = count(*) THEN 'none' WHEN abs(corr(CASE WHEN @ IS NULL THEN 1.0 ELSE 0.0 END, y)) >= 0.05 THEN 'MNAR' ELSE 'MCAR' END AS type", HOLES.sql))
def missingness_type(spark, sf):
    return P.missingness_type(HOLES.df(spark, sf).select("id", "size", "price", "code", "y"), ["y"])


@query("d15_categorical_inventory", """SELECT 'p_brand' AS "column", count(DISTINCT p_brand) AS cardinality, CASE WHEN count(DISTINCT p_brand) <= 2 THEN 'binary' WHEN count(DISTINCT p_brand) <= 15 THEN 'onehot' ELSE 'label' END AS encoding FROM part
 UNION ALL SELECT 'hole', count(DISTINCT nullif(p_type, 'x')) + 1, CASE WHEN count(DISTINCT p_type) + 1 <= 15 THEN 'onehot' ELSE 'label' END FROM part UNION ALL SELECT 'p_size', count(DISTINCT p_size), 'ordinal' FROM part""")
def categorical_inventory(spark, sf):
    p = read(spark, sf, "part").select("p_brand", "p_type", "p_size", "p_partkey")
    hole = p.unionByName(p.limit(1).withColumn("p_type", F.lit(None).cast("string"))).withColumnRenamed("p_type", "hole")
    return P.categorical_inventory(hole, {"p_size": "ordinal"})


@query("d16_data_sufficiency", "SELECT count(*) AS n, round(count(*) / 40, 9) AS ratio, CASE WHEN count(*) / 40 >= 50 THEN 'sufficient' WHEN count(*) / 40 >= 10 THEN 'borderline' ELSE 'insufficient' END AS verdict FROM part")
def data_sufficiency(spark, sf):
    return rounded(P.data_sufficiency(read(spark, sf, "part"), 40), ratio=9)


SEP = Input("lineitem", ("CASE WHEN l_discount + l_tax > 0.09 THEN 1 ELSE 0 END AS y", "l_discount AS disc", "l_quantity AS qty", "CASE WHEN l_linenumber = 2 THEN NULL ELSE l_tax END AS tax"))


def _stump_sql(c):
    return f"""SELECT '{c}' AS "column", arg_min(split, (g, split)) AS split, round(arg_min(f1, (g, split)), 9) AS f1 FROM (SELECT v AS split, round((nl * (1 - pow(pl / nl, 2) - pow(1 - pl / nl, 2)) + (n - nl) * (1 - pow((p - pl) / (n - nl), 2) - pow(1 - (p - pl) / (n - nl), 2))) / n, 10) AS g,
  coalesce(2 * (CASE WHEN pl * 2 > nl THEN pl ELSE 0 END + CASE WHEN (p - pl) * 2 > n - nl THEN p - pl ELSE 0 END) / nullif(CASE WHEN pl * 2 > nl THEN nl ELSE 0 END + CASE WHEN (p - pl) * 2 > n - nl THEN n - nl ELSE 0 END + p, 0), 0) AS f1
 FROM (SELECT v, sum(n) OVER (ORDER BY v) AS nl, sum(p) OVER (ORDER BY v) AS pl, sum(n) OVER () AS n, sum(p) OVER () AS p FROM (SELECT coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM {SEP.sql})) AS v, count(*) AS n, sum(y) AS p FROM {SEP.sql} GROUP BY 1)) WHERE nl < n)"""


@query("d17_class_separability", " UNION ALL ".join(map(_stump_sql, ["disc", "qty", "tax"])))
def class_separability(spark, sf):
    return rounded(P.class_separability(SEP.df(spark, sf), "y", ["disc", "qty", "tax"]), f1=9)


@query("d18_target_stats", "SELECT min(o_totalprice) AS min, max(o_totalprice) AS max, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, round(stddev_pop(o_totalprice), 4) AS std_pop FROM orders")
def target_stats(spark, sf):
    return rounded(P.target_stats(read(spark, sf, "orders"), "o_totalprice"), mean=4, std=4, std_pop=4)


@query("d19_block_prevalence", f"SELECT fold, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, round(avg(y), 9) AS prevalence FROM {PREDS.sql} GROUP BY 1")
def block_prevalence(spark, sf):
    return rounded(P.block_prevalence(PREDS.df(spark, sf), "fold", "y"), prevalence=9)


CUBE = Input("lineitem", ("CAST(l_suppkey % 5 AS INT) AS row", "CAST(l_partkey % 4 AS INT) AS col", "l_returnflag AS variable", "l_shipdate AS ts", "l_quantity AS value"))


@query("d28_cube_stats", f"SELECT row, col, variable, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS min, max(value) AS max FROM {CUBE.sql} GROUP BY 1, 2, 3")
def cube_stats(spark, sf):
    return rounded(P.cube_stats(CUBE.df(spark, sf)), mean=6, std=6)


def _mi_sql(c):
    bins = " + ".join(f"CASE WHEN x > q[{k}] THEN 1 ELSE 0 END" for k in range(1, 10))
    # equal edges count once
    return f"""SELECT '{c}' AS "column", round(sum(n / t * ln(n * t / (nb * ny))), 6) AS mi, round(sum(n / t * ln(n * t / (nb * ny))) / -sum(n / t * ln(ny / t)), 6) AS nmi FROM (
 SELECT n, sum(n) OVER (PARTITION BY b) AS nb, sum(n) OVER (PARTITION BY y) AS ny, sum(n) OVER () AS t FROM (
  SELECT CASE WHEN x IS NULL THEN -1 ELSE {bins} END AS b, y, count(*)::DOUBLE AS n FROM (SELECT {c} AS x, y FROM {SEP.sql}), (SELECT quantile_cont({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM {SEP.sql}) GROUP BY ALL))"""


@query("d32_mutual_information", " UNION ALL ".join(map(_mi_sql, ["disc", "qty", "tax"])))
def mutual_information(spark, sf):
    return rounded(P.mutual_information(SEP.df(spark, sf), ["disc", "qty", "tax"], "y"), mi=6, nmi=6)


@query("d34_infer_targets", "SELECT 'price' AS \"column\", 'regression' AS task, 0.5 AS weight UNION ALL SELECT 'flag', 'classification', 0.5")
def infer_targets(spark, sf):
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), (F.col("o_orderkey") % 2).alias("flag"))
    return P.infer_targets(o, "id")
