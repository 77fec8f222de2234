"""Queries of joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.operators import profile as P
from tessera.plans.registry import Input, query, read

AGG_SQL = """SELECT o_custkey, count(*) AS n, sum(l_extendedprice) AS price_sum, avg(l_extendedprice) AS price_avg, min(l_quantity) AS qty_min, max(l_quantity) AS qty_max,
 sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END) AS returned, sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0.0 END) AS accepted
 FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1"""


def account_aggregates(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    l = read(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("qty"))  # noqa: E741
    both = l.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    flags = {"returned": ("price", F.col("l_returnflag") == "R"), "accepted": ("price", F.col("l_returnflag") == "A")}
    return P.entity_aggregates(both, "o_custkey", {"price": ["sum", "avg"], "qty": ["min", "max"]}, flags)


@query("account_features", f"""WITH a AS ({AGG_SQL}) SELECT c_custkey, c_mktsegment, round(c_acctbal, 2) AS c_acctbal, coalesce(n, 0) AS n, round(coalesce(price_sum, 0), 2) AS price_sum,
 round(coalesce(price_avg, 0), 6) AS price_avg, coalesce(qty_min, 0) AS qty_min, coalesce(qty_max, 0) AS qty_max, round(coalesce(returned, 0), 2) AS returned, round(coalesce(accepted, 0), 2) AS accepted,
 coalesce(qty_min, 0) * coalesce(qty_max, 0) AS qty_min_x_qty_max, round(coalesce(returned, 0) / (coalesce(price_sum, 0) + 1e-9), 9) AS returned_div_price_sum
 FROM customer LEFT JOIN a ON o_custkey = c_custkey""")
def account_features(spark, sf):
    """The whole slice: scan, join, aggregate, enrich, zero fill, features."""
    from tessera.functions.scalar import interaction, ratio

    agg = account_aggregates(spark, sf).withColumnRenamed("o_custkey", "c_custkey")
    base = read(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.round("c_acctbal", 2).alias("c_acctbal"))
    full = J.enrich(base, [(agg, "c_custkey")])
    money = [F.round(c, 2).alias(c) for c in ("price_sum", "returned", "accepted")]
    return full.select("c_custkey", "c_mktsegment", "c_acctbal", "n", *money, F.round("price_avg", 6).alias("price_avg"), "qty_min", "qty_max", interaction("qty_min", "qty_max"), F.round(ratio("returned", "price_sum"), 9).alias("returned_div_price_sum"))


@query("c01_enrich", """SELECT o_orderkey, coalesce(q, 0) AS q_sum, coalesce(b, 0) AS bal FROM orders
 LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON l_orderkey = o_orderkey
 LEFT JOIN (SELECT c_custkey, count(*) AS b FROM customer WHERE c_acctbal > 0 GROUP BY 1) ON c_custkey = o_custkey""")
def enrich(spark, sf):
    q = read(spark, sf, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("q_sum"))
    b = read(spark, sf, "customer").filter("c_acctbal > 0").groupBy(F.col("c_custkey").alias("o_custkey")).agg(F.count("*").alias("bal"))
    return J.enrich(read(spark, sf, "orders").select("o_orderkey", "o_custkey"), [(q, "o_orderkey"), (b, "o_custkey")]).select("o_orderkey", "q_sum", "bal")


@query("c02_enrich_dim", """SELECT n_nationkey, n_name, s_name, n_name_dim FROM nation LEFT JOIN
 (SELECT s_nationkey, arg_min(s_name, s_suppkey) AS s_name, arg_min(CAST(s_suppkey AS VARCHAR), s_suppkey) AS n_name_dim FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey""")
def enrich_dim(spark, sf):
    s = read(spark, sf, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_name", F.col("s_suppkey").cast("string").alias("n_name"), "s_suppkey")
    return J.enrich_dim(read(spark, sf, "nation").select("n_nationkey", "n_name"), s, "n_nationkey", ["s_name", "n_name"], "_dim", "s_suppkey")


@query("c03_map_lookup", """SELECT c_custkey, coalesce(CASE WHEN n.n_regionkey < 3 THEN n.n_nationkey END, CASE WHEN n.n_regionkey >= 3 THEN 1000 + n.n_nationkey END) AS nation_id
 FROM customer JOIN nation n ON n.n_nationkey = c_nationkey""")
def map_lookup(spark, sf):
    n = read(spark, sf, "nation")
    c = read(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("name"))
    alias = n.select(F.lower("n_name").alias("alias"), F.col("n_name").alias("canonical"))
    ids = n.filter("n_regionkey < 3").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id"))
    more = n.filter("n_regionkey >= 3").select(F.col("n_name").alias("name"), (F.col("n_nationkey") + 1000).alias("id"))
    return J.map_lookup(c, "name", alias, ids, more, "nation_id").select("c_custkey", "nation_id")


GAMES = Input("orders", ("o_orderkey AS id", "o_custkey % 40 AS home", "(o_custkey * 7 + 3) % 40 AS away", "year(o_orderdate) AS t", "CASE WHEN o_orderstatus = 'F' THEN 1.0 WHEN o_orderstatus = 'P' THEN 0.5 ELSE 0.0 END AS outcome"))


@query("c04_history_rate", f"""WITH g AS (SELECT * FROM {GAMES.sql}), s AS (SELECT home AS team, t, outcome AS o FROM g UNION ALL SELECT away, t, 1 - outcome FROM g)
SELECT g.id, g.t, round(avg(s.o), 9) AS rate, count(s.o) > 0 AS has_history FROM g LEFT JOIN s ON s.team = g.home AND s.t < g.t GROUP BY g.id, g.t""")
def history_rate(spark, sf):
    g = GAMES.df(spark, sf)
    out = J.history_rate(g.select("id", F.col("home").alias("team"), "t"), g, "team", "t", "home", "away", F.col("outcome").cast("double"))
    return out.select("id", "t", F.round("rate", 9).alias("rate"), "has_history")


@query("c05_align_to_sample", "SELECT c_custkey AS id, c_custkey * 3 AS row_id, p.s FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS s FROM orders GROUP BY 1) p ON o_custkey = c_custkey")
def align_to_sample(spark, sf):
    pred = read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("s"))
    return J.align_to_sample(pred, read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 3).alias("row_id")), "id")


@query("c06_attach_columns", "SELECT p_partkey, p_size, p_brand FROM part")
def attach_columns(spark, sf):
    p = read(spark, sf, "part")
    return J.attach_columns(p.select("p_partkey", "p_size"), p.select("p_partkey", "p_brand"), "p_partkey")


@query("c07_id_mismatch", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'extra' ELSE 'missing' END AS issue FROM orders WHERE (o_orderkey % 3 = 0) <> (o_orderkey % 5 = 0)")
def id_mismatch(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey")
    return J.id_mismatch(o.filter("o_orderkey % 3 = 0"), o.filter("o_orderkey % 5 = 0"), "o_orderkey")


@query("c08_exclude_blocked", "SELECT p_partkey, p_brand FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size > 48)")
def exclude_blocked(spark, sf):
    p = read(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    failed = p.select("p_brand", (F.col("p_size") > 48).alias("do_not_retry")).filter("p_size > 20")
    return J.exclude_blocked(p, failed, "p_brand").select("p_partkey", "p_brand")


CELLS = Input("customer", ("CAST((c_custkey % 400) % 20 AS INT) AS row", "CAST(floor((c_custkey % 400) / 20) AS INT) AS col", "CASE WHEN c_custkey % 9 < 7 THEN NULL ELSE c_custkey END AS value"), "c_custkey <= 400")
POINTS = Input("supplier", ("s_suppkey AS id", "CAST((s_suppkey * 7) % 26 - 3 AS INT) AS row", "CAST((s_suppkey * 11) % 25 - 2 AS INT) AS col"))


@query("c09_nearest_valid_cell", f"""WITH c AS (SELECT * FROM {CELLS.sql} WHERE value IS NOT NULL), p AS (SELECT id, least(greatest(row, 0), 19) AS row, least(greatest(col, 0), 19) AS col FROM {POINTS.sql}),
 x AS (SELECT id, value, greatest(abs(c.row - p.row), abs(c.col - p.col)) AS radius, row_number() OVER (PARTITION BY id ORDER BY greatest(abs(c.row - p.row), abs(c.col - p.col)), c.row - p.row, c.col - p.col) AS k FROM p, c WHERE abs(c.row - p.row) <= 10 AND abs(c.col - p.col) <= 10)
SELECT p.id, x.value, x.radius FROM p LEFT JOIN x ON x.id = p.id AND k = 1""")
def nearest_valid_cell(spark, sf):
    return J.nearest_valid_cell(POINTS.df(spark, sf), CELLS.df(spark, sf), 20, 20)


@query("c13_coalesce_sources", """WITH a AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus = 'F' END AS done FROM orders WHERE o_orderkey % 7 <> 0),
 b AS (SELECT o_orderkey AS id, -1.0 AS price, o_orderstatus = 'O' AS done FROM orders WHERE o_orderkey % 5 <> 0)
SELECT coalesce(a.id, b.id) AS id, coalesce(a.price, b.price) AS price, coalesce(a.done, b.done) AS done, CASE WHEN a.price IS NOT NULL THEN 'primary' WHEN b.price IS NOT NULL THEN 'fallback' END AS price_source,
 CASE WHEN a.done IS NOT NULL THEN 'primary' WHEN b.done IS NOT NULL THEN 'fallback' END AS done_source FROM a FULL JOIN b ON a.id = b.id""")
def coalesce_sources(spark, sf):
    o = read(spark, sf, "orders").withColumnRenamed("o_orderkey", "id")
    a = o.filter("id % 7 <> 0").select("id", F.when(F.col("id") % 3 != 0, F.col("o_totalprice")).alias("price"), F.when(F.col("id") % 2 == 0, F.col("o_orderstatus") == "F").alias("done"))
    b = o.filter("id % 5 <> 0").select("id", F.lit(-1.0).alias("price"), (F.col("o_orderstatus") != "O").alias("open"))
    return J.coalesce_sources(a, b, "id", ["price", "done"], {"done": "open"})
