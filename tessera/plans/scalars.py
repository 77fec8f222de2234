"""Queries of the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.plans.registry import LINES, PREDS, Input, query, read

NATIONS = Input("supplier", ("s_suppkey AS id", "(s_suppkey * 7) % 170 - 85.0 AS lat", "(s_suppkey * 13) % 350 - 175.0 AS lon"))
CODES = Input("supplier", ("s_suppkey AS id", "CONCAT('WC-', CAST(1930 + s_suppkey % 90 AS STRING), '_M', CAST(s_suppkey AS STRING)) AS key", "CASE WHEN s_suppkey % 4 = 0 THEN 'nodash_1' WHEN s_suppkey % 7 = 0 THEN 'a-b_2' ELSE CONCAT('WC-', CAST(1930 + s_suppkey % 90 AS STRING), '_M1') END AS mixed"))


@query("h01_h04_row_features", f"""SELECT id, qty * qty AS qty_sq, qty * price AS qty_x_price, round(price / (tax + 1e-9), 3) AS price_div_tax,
 CASE WHEN qty < 10 THEN 1.0 ELSE 0.0 END AS low, CASE WHEN qty > 40 THEN 1.0 ELSE 0.0 END AS high, CASE WHEN tax = 0.02 THEN 1.0 ELSE 0.0 END AS two, 0.0 AS odd FROM {LINES.sql}""")
def row_features(spark, sf):
    return LINES.df(spark, sf).filter("true").select("id", S.polynomial("qty"), S.interaction("qty", "price"), F.round(S.ratio("price", "tax"), 3).alias("price_div_tax"), S.condition("qty", "lt", 10, "low"), S.condition("qty", "gt", 40, "high"), S.condition("tax", "eq", 0.02, "two"), S.condition("qty", "between", 3, "odd"))


@query("h05_target_transform", f"""SELECT id, round(ln(1 + qty), 9) AS log_y, round(exp(greatest(disc * 10 - 0.3, 0)) - 1, 9) AS back, greatest(tax - 0.04, 0) AS pois, least(greatest(qty, 5), 45) AS clipped FROM {LINES.sql}""")
def target_transform(spark, sf):
    return LINES.df(spark, sf).select("id", F.round(S.target_transform("qty", "rmsle"), 9).alias("log_y"), F.round(S.inverse_transform(F.col("disc") * 10 - 0.3, "rmsle"), 9).alias("back"), S.inverse_transform(F.col("tax") - 0.04, "poisson").alias("pois"), S.inverse_transform("qty", "rmse", 5.0, 45.0).alias("clipped"))


@query("h06_h08_submission_values", f"SELECT id, least(greatest(p * 2 - 0.5, 1e-7), 1 - 1e-7) AS p_open, CASE WHEN p >= 0.4 THEN 1 ELSE 0 END AS label, round(ln(1 + least(greatest(v, 3), 40)), 9) AS logged FROM {PREDS.sql}")
def submission_values(spark, sf):
    return PREDS.df(spark, sf).select("id", S.clip_open(F.col("p") * 2 - 0.5).alias("p_open"), S.hard_label("p", 0.4).alias("label"), F.round(S.submission_value("v", 3.0, 40.0, log=True), 9).alias("logged"))


@query("h09_h10_class_probabilities", f"""SELECT id, CASE WHEN disc >= tax AND disc >= 0.05 THEN 0 WHEN tax >= 0.05 THEN 1 ELSE 2 END AS cls,
 round(disc / CASE WHEN disc + tax + 0.05 = 0 THEN 1 ELSE disc + tax + 0.05 END, 9) AS p0 FROM {LINES.sql}""")
def class_probabilities(spark, sf):
    prob = F.array("disc", "tax", F.lit(0.05))
    return LINES.df(spark, sf).select("id", S.argmax_class(prob).alias("cls"), F.round(F.element_at(S.normalise_rows(prob), 1), 9).alias("p0"))


@query("h11_unit_sphere", f"SELECT id, round(cos(radians(lat)) * cos(radians(lon)), 9) AS x, round(cos(radians(lat)) * sin(radians(lon)), 9) AS y, round(sin(radians(lat)), 9) AS z FROM {NATIONS.sql}")
def unit_sphere(spark, sf):
    x, y, z = S.unit_sphere("lat", "lon")
    return NATIONS.df(spark, sf).select("id", F.round(x, 9).alias("x"), F.round(y, 9).alias("y"), F.round(z, 9).alias("z"))


@query("h12_haversine_to_centroid", f"""WITH t AS (SELECT * FROM {NATIONS.sql}), c AS (SELECT avg(lat) AS a, avg(lon) AS o FROM t)
SELECT id, round(2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(a - lat) / 2), 2) + cos(radians(lat)) * cos(radians(a)) * pow(sin(radians(o - lon) / 2), 2)))), 4) AS km FROM t, c""")
def haversine_to_centroid(spark, sf):
    t = NATIONS.df(spark, sf)
    centre = t.agg(F.avg("lat").alias("a"), F.avg("lon").alias("o"))  # one row
    return t.crossJoin(F.broadcast(centre)).select("id", F.round(S.haversine_km(F.col("lat"), F.col("lon"), F.col("a"), F.col("o")), 4).alias("km"))


@query("h13_year_from_key", f"SELECT id, coalesce(TRY_CAST(split_part(split_part(key, '_', 1), '-', 2) AS INT), 2026) AS year, coalesce(TRY_CAST(split_part(split_part(mixed, '_', 1), '-', 2) AS INT), 1930) AS year_or FROM {CODES.sql}")
def year_from_key(spark, sf):
    return CODES.df(spark, sf).select("id", S.year_from_key("key", 2026).alias("year"), S.year_from_key("mixed", 1930).alias("year_or"))


@query("h15_to_number", "SELECT o_orderkey AS id, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS rank, TRY_CAST(o_orderpriority AS DOUBLE) AS none, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders")
def to_number(spark, sf):
    o = read(spark, sf, "orders")
    odd = F.when(F.col("o_orderkey") % 3 == 0, F.lit("Infinity")).otherwise(F.col("o_totalprice").cast("string"))
    return o.select(F.col("o_orderkey").alias("id"), S.to_number(F.substring("o_orderpriority", 1, 1)).alias("rank"), S.to_number("o_orderpriority").alias("none"), S.to_number(odd).alias("price"))


@query("h16_normalise_token", "SELECT p_partkey AS id, regexp_replace(replace(lower(trim(' ' || p_name || '-X  y ')), '-', '_'), ' +', '_', 'g') AS token FROM part")
def normalise_token(spark, sf):
    return read(spark, sf, "part").select(F.col("p_partkey").alias("id"), S.normalise_token(F.concat(F.lit(" "), F.col("p_name"), F.lit("-X  y "))).alias("token"))


@query("h17_strip_strategy_prefix", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 3 THEN 'unknown' ELSE o_orderstatus END AS tag FROM orders")
def strip_strategy_prefix(spark, sf):
    n = F.col("o_orderkey") % 4
    raw = F.when(n == 0, F.concat(F.lit("config:"), "o_orderstatus")).when(n == 1, F.concat(F.lit("override:config:"), "o_orderstatus")).when(n == 2, F.col("o_orderstatus")).otherwise("config:unknown")
    return read(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), S.strip_strategy_prefix(raw).alias("tag"))


@query("h18_mentions", "SELECT doc_id AS id, list_aggregate(list_filter(['the', 'und', 'que', 'not-there'], lambda w: contains(lower(text), w)), 'string_agg', ',') AS words, len(list_filter(['the', 'und', 'que', 'not-there'], lambda w: contains(lower(text), w))) > 0 AS any_word FROM documents")
def mentions(spark, sf):
    found = S.mentions("text", ["the", "und", "que", "not-there"])
    return read(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.when(F.size(found) > 0, F.array_join(found, ",")).alias("words"), (F.size(found) > 0).alias("any_word"))


@query("h19_classify_text", "SELECT doc_id AS id, CASE WHEN regexp_matches(lower(text), 'idiot|moron') THEN 'ban' WHEN regexp_matches(lower(text), 'license|copyright') THEN 'clarify' ELSE 'question' END AS cls FROM documents")
def classify_text(spark, sf):
    return read(spark, sf, "documents").select(F.col("doc_id").alias("id"), S.classify_text("text", "idiot|moron", "license|copyright").alias("cls"))


@query("h20_comments", "SELECT p_partkey AS id, p_brand AS branch, CAST(p_size AS VARCHAR) AS oof, CAST(p_size % 5 AS INT) AS n, 'platt' AS calib FROM part")
def comments(spark, sf):
    text = S.build_comment(F.col("p_brand"), F.col("p_size"), F.col("p_size") % 5, F.lit("platt"))
    back = S.parse_comment(text)
    return read(spark, sf, "part").select(F.col("p_partkey").alias("id"), back["branch"].alias("branch"), back["oof"].alias("oof"), back["features"].cast("int").alias("n"), back["calib"].alias("calib"))


@query("h21_band_month", "SELECT l_orderkey * 8 + l_linenumber AS id, CASE WHEN l_linenumber = 1 THEN NULL ELSE 'qty_' || l_returnflag END AS band, CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(month(l_shipdate) AS INT) END AS month FROM lineitem")
def band_month(spark, sf):
    name = F.when(F.col("l_linenumber") == 1, F.lit("plain")).otherwise(F.concat(F.lit("qty_"), "l_returnflag", F.lit("_"), F.lpad(F.month("l_shipdate").cast("string"), 2, "0")))
    return read(spark, sf, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), *S.band_month(name))


METRICS = ["rmse", "auc", "f1", "log_loss", "mae", "accuracy", "rmsle", "r2"]


@query("h22_metric_facts", """WITH m AS (SELECT p_partkey AS id, (['rmse', 'auc', 'f1', 'log_loss', 'mae', 'accuracy', 'rmsle', 'r2'])[CAST(p_partkey % 8 + 1 AS INT)] AS metric FROM part)
SELECT id, metric, CASE WHEN metric IN ('rmse', 'mae', 'rmsle', 'r2') THEN 'regression' ELSE 'classification' END AS task, metric IN ('auc', 'log_loss') AS needs_probability, CASE WHEN metric IN ('auc', 'f1', 'accuracy', 'r2') THEN 'maximize' ELSE 'minimize' END AS direction FROM m""")
def metric_facts(spark, sf):
    name = F.element_at(F.array(*map(F.lit, METRICS)), (F.col("p_partkey") % 8 + 1).cast("int"))
    return read(spark, sf, "part").select(F.col("p_partkey").alias("id"), name.alias("metric")).select("id", "metric", *S.metric_facts("metric"))


@query("h23_impact_confidence", "SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 0.9 WHEN o_orderstatus = 'O' THEN 0.6 ELSE 0.5 END AS conf FROM orders")
def impact_confidence(spark, sf):
    s = F.when(F.col("o_orderstatus") == "F", "High").when(F.col("o_orderstatus") == "O", "low").otherwise("?")
    return read(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), S.impact_confidence(s).alias("conf"))


@query("h24_preview", "SELECT doc_id AS id, substr(text, 1, 240) AS head FROM documents")
def preview(spark, sf):
    return read(spark, sf, "documents").select(F.col("doc_id").alias("id"), S.preview("text", 240).alias("head"))


@query("h27_confidence_label", f"SELECT id, CASE WHEN p >= 0.6 THEN 1 ELSE 0 END AS label FROM {PREDS.sql} WHERE p >= 0.6 OR p <= 0.15")
def confidence_label(spark, sf):
    from tessera.operators.select import confident_rows

    return confident_rows(PREDS.df(spark, sf), "p", 0.6, 0.15).select("id", S.confidence_label("p", 0.6).alias("label"))


@query("c12_signature", "SELECT p_partkey AS id, CASE WHEN p_brand < p_type THEN p_brand || '|' || p_type ELSE p_type || '|' || p_brand END || '::ratio' AS signature FROM part")
def signature(spark, sf):
    return read(spark, sf, "part").select(F.col("p_partkey").alias("id"), S.signature_of(F.array("p_type", "p_brand"), F.lit("ratio")).alias("signature"))
