"""Queries of sources, projections, filters and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import select as S
from tessera.operators import sets
from tessera.operators.profile import per_column
from tessera.plans.registry import HOLES, LINES, PREDS, Input, query, read
from tessera.plans.scalars import NATIONS
from tessera.sources import tables


@query("a02_read_parquet", "SELECT l_orderkey, l_quantity, l_discount FROM lineitem WHERE l_quantity > 30 AND l_discount < 0.05")
def read_parquet(spark, sf):
    return tables.read_table(spark, f"{sf}/lineitem.parquet", columns=["l_orderkey", "l_quantity", "l_discount"]).filter("l_quantity > 30 AND l_discount < 0.05")


@query("a04_mask_to_null", "SELECT p_partkey, nullif(p_size, 7) AS p_size, p_retailprice, p_name FROM part")
def mask_to_null(spark, sf):
    return tables.mask_to_null(read(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_name").filter("p_partkey <> -1"), 7).withColumn("p_partkey", F.coalesce("p_partkey", F.lit(7).cast("long")))


@query("a10_artifact_manifest", f"SELECT branch, fold, count(*) AS n_rows, CAST(sum(CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ',' || CAST(y AS VARCHAR)), 1, 8) AS BIGINT)) AS BIGINT) AS content_hash FROM {PREDS.sql} GROUP BY ALL")
def artifact_manifest(spark, sf):
    return tables.artifact_manifest(PREDS.df(spark, sf), ["branch", "fold"], ["id", "y"])


@query("s01_fingerprint", "SELECT count(*) AS n_rows, CAST(sum(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ',' || o_orderstatus || ',' || o_orderpriority), 1, 8) AS BIGINT)) AS BIGINT) AS content_hash FROM orders")
def fingerprint(spark, sf):
    return tables.fingerprint(read(spark, sf, "orders"), ["o_orderkey", "o_orderstatus", "o_orderpriority"])


@query("s02_verify_fingerprint", """WITH h AS (SELECT o_orderpriority AS table_name, o_orderkey AS k FROM orders),
a AS (SELECT table_name, sum(k) AS s FROM h WHERE table_name < '5' GROUP BY 1), b AS (SELECT table_name, sum(CASE WHEN table_name < '2' THEN k + 1 ELSE k END) AS s FROM h WHERE table_name > '2' OR table_name < '2' GROUP BY 1)
SELECT coalesce(a.table_name, b.table_name) AS table_name, CASE WHEN b.s IS NULL THEN 'new' WHEN a.s IS NULL THEN 'missing' WHEN a.s = b.s THEN 'ok' ELSE 'changed' END AS status FROM a FULL JOIN b ON a.table_name = b.table_name""")
def verify_fingerprint(spark, sf):
    rows = read(spark, sf, "orders").select(F.col("o_orderpriority").alias("table_name"), "o_orderkey")
    then = rows.withColumn("o_orderkey", F.col("o_orderkey") + (F.col("table_name") < "2").cast("int"))
    made = lambda df: tables.artifact_manifest(df, ["table_name"], ["o_orderkey"])
    return tables.verify_fingerprint(made(rows.filter("table_name < '5'")), made(then))


@query("b02_select_variant", "SELECT p_partkey, p_size, p_name FROM part")
def select_variant(spark, sf):
    part = read(spark, sf, "part").select("p_partkey", "p_size", "p_brand", "p_name", "p_type")
    return S.select_variant(part, "variant_2", ["p_size", "p_brand", "p_name", "p_type"], ["p_partkey"])


@query("b03_drop_listed", "SELECT p_partkey, p_size, p_retailprice FROM part")
def drop_listed(spark, sf):
    return S.drop_listed(read(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_name", "p_brand"), ["p_name"], ["p_brand", "not_there"])


@query("b04_rename_columns", "SELECT p_partkey AS id, p_size AS size, p_brand FROM part")
def rename_columns(spark, sf):
    return S.rename_columns(read(spark, sf, "part").select("p_partkey", "p_size", "p_brand"), {"p_partkey": "id", "p_size": "size", "gone": "x"})


def counted(df, issues):
    """Findings about columns, with the number of values of those that exist."""
    n = per_column(df, df.columns, lambda c: [("n", F.count(c))])
    return issues.join(n, "column", "left")


def _n(table, rows):
    """SQL of findings (a tuple each, the column first) with the column's count."""
    return " UNION ALL ".join(f"SELECT {', '.join(row)}, {f'(SELECT count({column}) FROM {table})' if there else 'NULL'} AS n" for column, there, *row in rows)


def _col(c):
    return f"'{c}' AS \"column\""


@query("b01_feature_columns", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount")))
def feature_columns(spark, sf):
    d = read(spark, sf, "lineitem")
    left = S.feature_columns(d, ids=["l_orderkey", "L_PARTKEY", "l_suppkey"], targets=["l_tax"], blocked=["L_LineNumber"], numeric_only=True)
    return per_column(d, left, lambda c: [("n", F.count(c)), ("mean", F.round(F.avg(c), 6))])


@query("b05_schema_parity", _n("part", [("p_name", True, _col("p_name"), "'missing_in_test' AS issue"), ("x", False, _col("made"), "'extra_in_test' AS issue"), ("x", False, _col("gone"), "'target_missing' AS issue")]))
def schema_parity(spark, sf):
    part = read(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    test = part.drop("p_name").withColumn("made", F.lit(1))
    return counted(part, S.schema_parity(part, test, "gone"))


@query("b06_policy_gate", _n("customer", [(c, True, _col(c)) for c in ("c_name", "c_acctbal")]))
def policy_gate(spark, sf):
    d = read(spark, sf, "customer")
    return counted(d, S.policy_gate(d, ["C_NAME", "c_acctbal", "c_phone"]))


@query("b08_pii_columns", _n("supplier", [("s_name", True, _col("s_name"))]))
def pii_columns(spark, sf):
    d = read(spark, sf, "supplier")
    return counted(d, S.pii_columns(d))


@query("b14_target_leak_guard", _n(HOLES.sql, [(c, True, _col(c), f"{str(c in ('size', 'price')).lower()} AS refused") for c in ("id", "size", "price", "y")]))
def target_leak_guard(spark, sf):
    d = HOLES.df(spark, sf).select("id", "size", "price", "y")
    spec = {"polynomials": ["size"], "ratios": [("price", "size")]}

    def refused(c):
        try:
            S.target_leak_guard(spec, c)
        except ValueError:
            return True
        return False

    return counted(d, spark.createDataFrame([(c, refused(c)) for c in d.columns], "column string, refused boolean"))


@query("b15_validate_variant_lists", _n("part", [("p_size", True, _col("p_size"), "'a' AS variant", "'target' AS issue"), ("p_name", True, _col("p_name"), "'a' AS variant", "'dead' AS issue"), ("p_brand", True, _col("p_brand"), "'b' AS variant", "'noise' AS issue"), ("x", False, _col("gone"), "'b' AS variant", "'not_in_test' AS issue")]))
def validate_variant_lists(spark, sf):
    d = read(spark, sf, "part")
    return counted(d, S.validate_variant_lists(d, {"a": ["p_size", "p_name", "p_type"], "b": ["p_brand", "gone"]}, "p_size", ["p_name"], ["p_brand"]))


@query("b18_numeric_columns", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, CAST(max({c}) AS DOUBLE) AS largest FROM part" for c in ("p_partkey", "p_size", "p_retailprice")))
def numeric_columns(spark, sf):
    d = read(spark, sf, "part")
    return per_column(d, S.numeric_columns(d), lambda c: [("n", F.count(c)), ("largest", F.max(c).cast("double"))])


PLAN_SQL = """SELECT p_name AS name, CASE WHEN p_partkey % 6 = 0 THEN 'external' WHEN p_partkey % 6 = 1 THEN 'web' ELSE 'internal' END AS source,
 CASE WHEN p_size % 5 = 0 THEN 'target_encode' ELSE 'none' END AS transform, CASE WHEN p_size % 7 = 0 THEN ['Lat', 'x'] ELSE [p_brand] END AS columns, p_partkey FROM part"""


def _plan(spark, sf):
    p = read(spark, sf, "part")
    source = F.when(F.col("p_partkey") % 6 == 0, "external").when(F.col("p_partkey") % 6 == 1, "web").when(F.col("p_partkey") % 6 == 2, F.lit(None).cast("string")).otherwise("internal")
    item = F.struct(F.concat_ws("#", "p_name", "p_partkey").alias("name"), source.alias("source"), F.when(F.col("p_size") % 5 == 0, "target_encode").alias("transform"), F.when(F.col("p_size") % 7 == 0, F.array(F.lit("Lat"), F.lit("x"))).otherwise(F.array("p_brand")).alias("columns"))
    return S.flatten_plan(p.groupBy("p_brand").agg(F.collect_list(item).alias("features")))


@query("b07_check_planned_features", f"""SELECT name || '#' || CAST(p_partkey AS VARCHAR) AS name,
 CASE WHEN source = 'external' OR transform = 'target_encode' OR list_contains(columns, 'Lat') THEN 'BLOCK' WHEN source = 'web' THEN 'WARN' ELSE 'PASS' END AS verdict,
 CASE WHEN source = 'external' THEN 'external source' WHEN transform = 'target_encode' THEN 'banned transform' WHEN list_contains(columns, 'Lat') THEN 'place columns' WHEN source = 'web' THEN 'unlisted source' ELSE 'ok' END AS reason FROM ({PLAN_SQL})""")
def check_planned_features(spark, sf):
    return S.check_planned_features(_plan(spark, sf), ["Target_Encode"], False, ["internal"])


@query("b16_flatten_plan", f"SELECT name || '#' || CAST(p_partkey AS VARCHAR) AS name, source, transform, array_to_string(columns, ',') AS columns FROM ({PLAN_SQL})")
def flatten_plan(spark, sf):
    return _plan(spark, sf).withColumn("columns", F.array_join("columns", ","))


@query("b17_feature_policy", "SELECT p_partkey AS id, NOT (p_size % 3 = 0) AS place_ok, p_size % 2 = 0 AS external_ok, false AS automl_ok FROM part")
def feature_policy(spark, sf):
    p = read(spark, sf, "part")
    bans = F.when(F.col("p_size") % 3 == 0, F.array(F.lit("No Latitude use"), F.col("p_brand"))).when(F.col("p_size") % 3 == 1, F.array("p_brand"))
    return p.select(F.col("p_partkey").alias("id"), *S.feature_policy(bans, F.when(F.col("p_size") % 2 == 0, True), F.lit(None).cast("boolean")))


@query("b09_bbox_filter", f"SELECT * FROM {NATIONS.sql} WHERE lat BETWEEN -40 AND 41 AND lon BETWEEN -100.0 AND 20")
def bbox_filter(spark, sf):
    return S.bbox_filter(NATIONS.df(spark, sf), "lat", "lon", (-40, 41, -100, 20))


@query("b10_time_slice", "SELECT event_id, user_id FROM events WHERE ts BETWEEN (SELECT min(ts) + INTERVAL 1 DAY FROM events) AND (SELECT min(ts) + INTERVAL 9 DAY FROM events)")
def time_slice(spark, sf):
    ev = read(spark, sf, "events")
    start = ev.agg(F.min("ts")).first()[0]
    import datetime as dt

    return S.time_slice(ev, "ts", start + dt.timedelta(days=1), start + dt.timedelta(days=9)).select("event_id", "user_id")


@query("b11_confident_rows", f"SELECT id, p FROM {PREDS.sql} WHERE p >= 0.6 OR p <= 0.15")
def confident_rows(spark, sf):
    return S.confident_rows(PREDS.df(spark, sf), "p", 0.15, 0.6).select("id", "p")


@query("b12_complete_pairs", f"SELECT id, size, price FROM {HOLES.sql} WHERE size IS NOT NULL AND price IS NOT NULL")
def complete_pairs(spark, sf):
    return S.complete_pairs(HOLES.df(spark, sf).select("id", "size", "price"), "size", "price")


@query("b13_verified_candidates", f"WITH s AS (SELECT branch, count(*) AS n_rows FROM {PREDS.sql} GROUP BY 1) SELECT branch, n_rows FROM s WHERE branch IN ('b0', 'b1') AND n_rows = (SELECT max(n_rows) FROM s WHERE branch IN ('b0', 'b1', 'b2'))")
def verified_candidates(spark, sf):
    p = PREDS.df(spark, sf)
    most = p.groupBy("branch").count().agg(F.max("count")).first()[0]
    both = p.select("branch").unionByName(p.select(F.concat("branch", F.lit("_augmented")).alias("branch")))
    ok = spark.createDataFrame([("b0",), ("b1",), ("b0_augmented",)], "branch string")
    return S.verified_candidates(both, ok, most, False).withColumnRenamed("rows", "n_rows")


@query("g01_stack_splits", "SELECT 'train' AS split, o_orderkey AS id, o_totalprice AS price, o_orderpriority AS extra FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'test', o_orderkey, o_totalprice, NULL FROM orders WHERE o_orderkey % 2 = 1")
def stack_splits(spark, sf):
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("extra"))
    return sets.stack_splits(o.filter("id % 2 = 0"), o.filter("id % 2 = 1").drop("extra"))


@query("g02_append_pseudo", f"SELECT id, y, 1.0 AS weight, false AS is_pseudo FROM {PREDS.sql} WHERE fold < 3 UNION ALL SELECT id, CASE WHEN p >= 0.6 THEN 1 ELSE 0 END, 0.5, true FROM {PREDS.sql} WHERE fold >= 3 AND (p >= 0.6 OR p <= 0.15)")
def append_pseudo(spark, sf):
    p = PREDS.df(spark, sf)
    return sets.append_pseudo(p.filter("fold < 3").select("id", "y"), p.filter("fold >= 3").select("id", "p"), pos=0.6, neg=0.15)


@query("g03_constant_in_both", "SELECT c AS \"column\" FROM (SELECT unnest(['one', 'flag']) AS c)")
def constant_in_both(spark, sf):
    x = HOLES.df(spark, sf).withColumns({"flag": F.lit("z"), "y": F.lit(1), "half": (F.col("id") % 2).cast("int")})
    names = sets.constant_in_both(x.filter("id % 2 = 0"), x.filter("id % 2 = 1"), protect=["y"])
    return S.names_frame(x, [(c,) for c in names if c not in ("half",)], "column string")


@query("g04_merge_banned", "SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN p_brand || ',leak,' || p_type ELSE 'leak,' || p_type END AS banned FROM part")
def merge_banned(spark, sf):
    p = read(spark, sf, "part")
    a = F.when(F.col("p_size") % 2 == 0, F.array(F.col("p_brand"), F.lit(None).cast("string")))
    return p.select(F.col("p_partkey").alias("id"), F.array_join(S.merge_banned(a, F.array(F.lit("leak"), F.lit("leak")), F.array("p_type", "p_type")), ",").alias("banned"))


@query("c10_split_overlap", f"SELECT DISTINCT id FROM {LINES.sql} WHERE line <= 3 AND qty > 25")
def split_overlap(spark, sf):
    x = LINES.df(spark, sf)
    return sets.split_overlap(x.filter("line <= 3"), x.filter("qty > 25"), "id")


def _folder(spark):
    from tessera.sources.shared import new_path

    return new_path(spark, "files")


@query("a01_read_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def read_csv(spark, sf):
    path, c = f"{_folder(spark)}.csv", read(spark, sf, "customer")
    c.write.option("header", True).csv(path)
    return tables.read_table(spark, path, schema=c.schema)


@query("a03_load_manifest", "SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'orders', count(*) FROM orders")
def load_manifest(spark, sf):
    found = tables.load_manifest(spark, sf, {"nation": "nation.parquet", "orders": "orders.parquet", "none": "none.parquet"})
    one = [df.agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n, df in found.items()]
    return one[0].unionByName(one[1])


@query("a05_write_features", "SELECT p_partkey, p_size, CASE WHEN p_partkey % 2 = 0 THEN 'b0' ELSE 'b1' END AS branch FROM part")
def write_features(spark, sf):
    path, p = _folder(spark), read(spark, sf, "part").select("p_partkey", "p_size")
    for k in (0, 1, 1):
        tables.write_features(p.filter(F.col("p_partkey") % 2 == k), path, f"b{k}")
    return spark.read.parquet(path)


@query("a06_write_predictions", f"SELECT id, p, branch, 'y' AS target, 'oof' AS kind FROM {PREDS.sql}")
def write_predictions(spark, sf):
    path, p = _folder(spark), PREDS.df(spark, sf)
    for b in ("b0", "b1", "b2"):
        tables.write_predictions(p.filter(F.col("branch") == b).select("id", "p"), path, b, "y", "oof")
    return spark.read.parquet(path)


@query("a07_write_submission", "SELECT c_custkey AS id, c_nationkey AS label FROM customer")
def write_submission(spark, sf):
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("label"))
    out = tables.write_submission(c, _folder(spark), "labels", "id")
    return tables.read_table(spark, out, schema=c.schema) if out.endswith(".csv") else spark.read.schema(c.schema).option("header", True).csv(out)
