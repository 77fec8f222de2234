"""Queries of fitted transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import transforms as T
from tessera.plans.aggregates import rounded
from tessera.plans.registry import HOLES, PREDS, Input, query, read
from tessera.plans.scalars import NATIONS

H = HOLES.sql


def split(df, key="id"):
    return df.filter(f"{key} % 4 <> 0"), df.filter(f"{key} % 4 = 0")


@query("i01_clean", f"SELECT id, CASE WHEN size IS NULL THEN 1 ELSE 0 END AS size_is_missing, coalesce(price, (SELECT quantile_cont(price, 0.5) FROM {H} WHERE id % 4 <> 0)) AS price FROM {H} WHERE id % 4 = 0")
def clean(spark, sf):
    a, b = split(HOLES.df(spark, sf))
    _, test, done = T.clean(a, b, ["size"], ["price"], protect=["y"])
    assert done["dropped"] == ["one"]
    return test.select("id", "size_is_missing", "price")


@query("i02_impute", f"SELECT id, coalesce(price, (SELECT quantile_cont(price, 0.5) FROM {H} WHERE id % 4 <> 0)) AS price, coalesce(code, (SELECT quantile_cont(code, 0.5) FROM {H} WHERE id % 4 <> 0)) AS code, coalesce(brand, (SELECT brand FROM {H} WHERE id % 4 <> 0 AND brand IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, brand LIMIT 1)) AS brand FROM {H} WHERE id % 4 = 0")
def impute(spark, sf):
    a, b = split(HOLES.df(spark, sf))
    return T.impute(a, b, ["price", "code", "brand"])[1].select("id", "price", "code", "brand")


@query("i03_zero_fill", f"SELECT id, coalesce(size, 0) AS size FROM {H}")
def zero_fill(spark, sf):
    return T.zero_fill_mnar(HOLES.df(spark, sf), ["size"]).select("id", "size")


@query("h14_age", "SELECT o_orderkey AS id, coalesce(2015 - CASE WHEN o_orderkey % 5 <> 0 THEN year(o_orderdate) END, (SELECT quantile_cont(2015 - year(o_orderdate), 0.5) FROM orders WHERE o_orderkey % 5 <> 0)) AS age FROM orders")
def age(spark, sf):
    o = read(spark, sf, "orders")
    text = F.when(F.col("o_orderkey") % 5 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    a = o.select(F.col("o_orderkey").alias("id"), (2015 - F.year(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))).cast("double").alias("age"))
    return T.impute(a, a, ["age"])[0]


@query("h25_fill_constant", f"SELECT id, coalesce(size, 0) AS size, coalesce(price, 0) AS price, code FROM {H}")
def fill_constant(spark, sf):
    x = HOLES.df(spark, sf).select("id", "size", "price", "code")
    return x.fillna(0, subset=[c for c in x.columns if c not in ("id", "code")])


@query("h26_missing_indicator", f"SELECT id, CASE WHEN size IS NULL THEN 1 ELSE 0 END AS size_is_missing, CASE WHEN code IS NULL THEN 1 ELSE 0 END AS code_is_missing FROM {H}")
def missing_indicator(spark, sf):
    return HOLES.df(spark, sf).select("id", S.missing_indicator("size"), S.missing_indicator("code"))


def _bins(edges, x="x"):
    """Bin between distinct edges by a list of six; null outside the first and last."""
    inner = " + ".join(f"CASE WHEN {x} > {edges}[{k}] AND {edges}[{k}] > {edges}[{k - 1}] AND {edges}[{k}] > {edges}[1] AND {edges}[{k}] < {edges}[6] THEN 1 ELSE 0 END" for k in range(2, 6))
    return f"CASE WHEN {edges}[1] < {edges}[6] AND {x} BETWEEN {edges}[1] AND {edges}[6] THEN {inner} END"


Q5 = "[0, 0.2, 0.4, 0.6, 0.8, 1]"
BIN_ROWS = f"(SELECT id, fold, y, CASE WHEN id % 13 = 0 THEN NULL ELSE round(p, 6) END AS x FROM {PREDS.sql})"
#: The other side reaches beyond the training side on both ends.
BIN_TEST = f"(SELECT id, CASE WHEN id % 11 = 0 THEN x * 4 - 2 ELSE x END AS x FROM {BIN_ROWS})"


@query("i04_target_bin_mean_cv", f"""WITH f AS (SELECT DISTINCT fold AS f FROM {PREDS.sql}), e AS (SELECT f, quantile_cont(x, {Q5}) AS q, avg(y) AS a FROM f JOIN {BIN_ROWS} r ON r.fold <> f GROUP BY f),
 m AS (SELECT e.f, {_bins('q')} AS b, avg(y) AS m FROM e JOIN {BIN_ROWS} r ON r.fold <> e.f GROUP BY ALL)
SELECT id, round(coalesce(m.m, a), 9) AS x_bin_mean FROM (SELECT id, e.f, a, {_bins('q')} AS b FROM {BIN_ROWS} r JOIN e ON e.f = r.fold) r LEFT JOIN m ON m.f = r.f AND m.b = r.b""")
def target_bin_mean_cv(spark, sf):
    d = PREDS.df(spark, sf).select("id", "fold", "y", F.when(F.col("id") % 13 != 0, F.round("p", 6)).alias("x"))
    return rounded(T.target_bin_mean(d, d, "x", "y", 5, "fold")[0].select("id", "x_bin_mean"), x_bin_mean=9)


@query("i04_target_bin_mean", f"""WITH e AS (SELECT quantile_cont(x, {Q5}) AS q, avg(y) AS a FROM {BIN_ROWS}), m AS (SELECT {_bins('q')} AS b, avg(y) AS m FROM e, {BIN_ROWS} GROUP BY 1)
SELECT id, round(coalesce(m.m, a), 9) AS x_bin_mean FROM (SELECT id, a, {_bins('q')} AS b FROM {BIN_TEST}, e) r LEFT JOIN m ON m.b = r.b""")
def target_bin_mean(spark, sf):
    d = PREDS.df(spark, sf).select("id", "y", F.when(F.col("id") % 13 != 0, F.round("p", 6)).alias("x"))
    other = d.withColumn("x", F.when(F.col("id") % 11 == 0, F.col("x") * 4 - 2).otherwise(F.col("x")))
    return rounded(T.target_bin_mean(d, other, "x", "y", 5)[1].select("id", "x_bin_mean"), x_bin_mean=9)


@query("i05_standardise", f"SELECT id, round((price - (SELECT avg(price) FROM {H} WHERE id % 4 <> 0)) / (SELECT stddev_pop(price) FROM {H} WHERE id % 4 <> 0), 6) AS price, one - 1.0 AS one FROM {H} WHERE id % 4 = 0")
def standardise(spark, sf):
    a, b = split(HOLES.df(spark, sf).withColumn("one", F.col("one").cast("double")))
    return rounded(T.standardise(a, b, ["price", "one"])[1].select("id", "price", "one"), price=6)


@query("i06_pca_features")
def pca_features(spark, sf):
    a, b = split(HOLES.df(spark, sf).withColumn("code", F.col("code").cast("double")))
    return T.pca_features(a, b, ["size", "price", "code"], 2)[1].select("id", "pca_1", "pca_2")


@query("i07_build_features", f"""SELECT id, size * size AS size_sq, size * price AS size_x_price, round(price / (size + 1e-9), 6) AS price_div_size, CASE WHEN size > 30 THEN 1.0 ELSE 0.0 END AS large,
 round(coalesce((SELECT avg(y) FROM {H} t WHERE t.id % 4 <> 0 AND (t.price > m) = (h.price > m) AND h.price BETWEEN lo AND hi), (SELECT avg(y) FROM {H} WHERE id % 4 <> 0)), 9) AS pb FROM {H} h, (SELECT quantile_cont(price, 0.5) AS m, min(price) AS lo, max(price) AS hi FROM {H} WHERE id % 4 <> 0) WHERE id % 4 = 0""")
def build_features(spark, sf):
    a, b = split(HOLES.df(spark, sf))
    spec = {"polynomials": ["size", "gone"], "interactions": [("size", "price")], "ratios": [("price", "size")], "conditions": [{"column": "size", "operator": "gt", "value": 30, "name": "big"}], "target_dependent_bins": [{"column": "price", "q": 2, "name": "pb"}], "aliases": {"big": "large"}}
    return rounded(T.build_features(a, b, spec, "y")[1].select("id", "size_sq", "size_x_price", "price_div_size", "large", "pb"), price_div_size=6, pb=9)


@query("i08_default_spec", f"SELECT id, size * size AS size_sq, CASE WHEN code IS NULL THEN 1.0 ELSE 0.0 END * size AS code_missing_x_size FROM {H} WHERE id % 4 = 0")
def default_spec(spark, sf):
    from tessera.operators.profile import null_profile

    a, b = split(HOLES.df(spark, sf).select("id", "size", "price", F.col("code").cast("double").alias("code"), "y"))
    holes = {r["column"]: r for r in null_profile(a.select("size", "code")).collect()}
    mnar = [max(holes, key=lambda c: holes[c]["nulls"])]
    spec = T.merge_spec(T.default_spec({"mnar": mnar, "features": ["size", "price"]}), {"polynomials": ["size"], "interaction_features": ["size", "price"], "interaction_top": 1})
    return T.build_features(a, b, spec, "y")[1].select("id", "size_sq", "code_missing_x_size")


@query("i09_temporal_deltas", "WITH m AS (SELECT l_suppkey, sum(l_quantity) FILTER (WHERE month(l_shipdate) = 1) AS a, sum(l_quantity) FILTER (WHERE month(l_shipdate) = 2) AS b, sum(l_quantity) FILTER (WHERE month(l_shipdate) = 3) AS c FROM lineitem GROUP BY 1) SELECT l_suppkey, b - a AS qty_delta_02, c - b AS qty_delta_03 FROM m")
def temporal_deltas(spark, sf):
    from tessera.plans.aggregates import _months

    return T.temporal_deltas(_months(spark, sf).select("l_suppkey", "qty_01", "qty_02", "qty_03"), "qty").select("l_suppkey", "qty_delta_02", "qty_delta_03")


@query("i10_missingness_interactions", f"SELECT id, CASE WHEN code IS NULL THEN 1.0 ELSE 0.0 END * size AS code_missing_x_size FROM {H}")
def missingness_interactions(spark, sf):
    return T.missingness_interactions(HOLES.df(spark, sf), ["code"], "y", ["size", "price"], 1).select("id", "code_missing_x_size")


NEAR = f"""WITH t AS (SELECT id, lat, lon, id % 3 AS fold, id % 7 AS y FROM {NATIONS.sql}), n AS (SELECT a.id, b.y, b.fold AS f2, a.fold, b.id AS other,
 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) AS km
 FROM t a, t b WHERE a.id <> b.id)"""


def _near(spark, sf):
    return NATIONS.df(spark, sf).withColumns({"fold": F.col("id") % 3, "y": F.col("id") % 7})


@query("i11_spatial_lag_target", NEAR + ", k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(km, 6), other) AS p FROM n WHERE f2 <> fold) SELECT t.id, round(avg(k.y), 9) AS spatial_lag FROM t LEFT JOIN k ON k.id = t.id AND p <= 3 GROUP BY 1")
def spatial_lag_target(spark, sf):
    return rounded(T.spatial_lag_target(_near(spark, sf), "lat", "lon", "id", "y", 3, "fold").select("id", "spatial_lag"), spatial_lag=9)


@query("i12_neighbour_distance", NEAR + ", k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(km, 6), other) AS p FROM n) SELECT t.id, round(avg(km), 4) AS neighbour_km FROM t LEFT JOIN k ON k.id = t.id AND p <= 3 GROUP BY 1")
def neighbour_distance(spark, sf):
    return rounded(T.neighbour_distance(_near(spark, sf), "lat", "lon", "id", 3).select("id", "neighbour_km"), neighbour_km=4)


@query("i13_median_fill_matrix", f"SELECT id, coalesce(price, (SELECT quantile_cont(price, 0.5) FROM {H} WHERE id % 4 <> 0)) AS price, 0.0 AS void FROM {H} WHERE id % 4 = 0")
def median_fill_matrix(spark, sf):
    a, b = split(HOLES.df(spark, sf).withColumn("void", F.lit(None).cast("double")))
    return T.median_fill_matrix(a, b, ["price", "void"])[1].select("id", "price", "void")
