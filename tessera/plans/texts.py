"""Queries of the text jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import text as T
from tessera.plans.registry import Input, query, read

WORDS = ["der ", "que ", "would"]


@query("r01_flag_threads", """WITH p AS (SELECT conv_id, text, role FROM conversations WHERE turn = 0), c AS (SELECT conv_id, count(*) FILTER (WHERE contains(lower(text), 'der ') OR contains(lower(text), 'que ') OR contains(lower(text), 'would')) AS n, bool_or(role = 'system') AS r FROM conversations WHERE turn > 0 GROUP BY 1)
SELECT p.conv_id AS thread_id, CASE WHEN regexp_matches(lower(text), 'une|und') THEN 'ban' WHEN regexp_matches(lower(text), 'the') THEN 'clarify' ELSE 'question' END AS cls, coalesce(n, 0) AS flagged_comments, '' AS sources, coalesce(r, false) AS resolved FROM p LEFT JOIN c USING (conv_id)
WHERE contains(lower(text), 'der ') OR contains(lower(text), 'que ') OR contains(lower(text), 'would') OR coalesce(n, 0) > 0 OR role = 'system'""")
def flag_threads(spark, sf):
    posts, comments = T.threads_of(read(spark, sf, "conversations"))
    out = T.flag_threads(posts.withColumn("title", F.lit("")), comments, WORDS, ["system"], ["system"], "une|und", "the")
    return out.withColumn("sources", F.array_join("sources", ","))


@query("r02_carry_overrides", "SELECT page_id, url AS source_url, page_id % 5 = 0 AS superseded FROM pages")
def carry_overrides(spark, sf):
    p = read(spark, sf, "pages").select("page_id", F.concat_ws("#", "url", "page_id").alias("source_url"))
    before = p.filter("page_id % 10 = 0 OR page_id % 10 = 5").select("source_url", F.lit(True).alias("superseded"))
    return T.carry_overrides(p, before).withColumn("source_url", F.regexp_replace("source_url", "#[0-9]+$", ""))


PAGE = Input("pages", ("page_id AS id", "CONCAT('<p>Evaluation metric: ', CASE WHEN page_id % 3 = 0 THEN 'RMSE' WHEN page_id % 3 = 1 THEN 'AUC' ELSE 'unknown' END, '</p><p>', CAST(page_id % 9 + 1 AS STRING), ' submissions per day, teams of up to ', CAST(page_id % 4 + 1 AS STRING), ', $ ', CAST(page_id % 7 AS STRING), ',500 by 2026-0', CAST(page_id % 9 + 1 AS STRING), '-15. AutoML is allowed</p>', html) AS html"))


@query("r03_extract_rules", "SELECT page_id AS id, CASE page_id % 3 WHEN 0 THEN 'rmse' WHEN 1 THEN 'auc' END AS metric, CAST(page_id % 9 + 1 AS INT) AS daily_limit, CAST(page_id % 4 + 1 AS INT) AS team_size, CAST(page_id % 7 AS BIGINT) * 1000 + 500 AS prize, CAST('2026-0' || CAST(page_id % 9 + 1 AS VARCHAR) || '-15' AS DATE) AS deadline, true AS automl_allowed, false AS external_allowed FROM pages")
def extract_rules(spark, sf):
    p = PAGE.df(spark, sf).select("id", T.stripped("html").alias("body"))
    return T.extract_rules(p, "body").select("id", "metric", "daily_limit", "team_size", "prize", "deadline", "automl_allowed", "external_allowed")


SIGNALS = {"Germanic": ["und ", "der "], "Romance": ["que ", "une "], "English": ["the "]}


def _has(words):
    return "len(list_filter([" + ", ".join(f"'{w}'" for w in words) + "], lambda w: contains(lower(text), w))) > 0"


@query("r04_tag_literature", f"""WITH t AS (SELECT doc_id, array_to_string(list_filter([CASE WHEN {_has(SIGNALS['Germanic'])} THEN 'Germanic' END, CASE WHEN {_has(SIGNALS['Romance'])} THEN 'Romance' END, CASE WHEN {_has(SIGNALS['English'])} THEN 'English' END], lambda x: x IS NOT NULL), ', ') AS labels,
 array_to_string(list_sort(list_filter(['und ', 'der ', 'que ', 'une ', 'the '], lambda w: contains(lower(text), w))), ',') AS variables FROM documents) SELECT labels, variables, min(doc_id) AS doc_id FROM t WHERE labels <> '' GROUP BY 1, 2 ORDER BY 3 LIMIT 16""")
def tag_literature(spark, sf):
    return T.tag_literature(read(spark, sf, "documents"), "doc_id", "text", SIGNALS)


@query("r05_pattern_table", "SELECT format('P{:05d}', row_number() OVER (ORDER BY p_partkey)) AS pattern, p_name AS title, CASE WHEN p_size % 3 = 0 THEN 0.9 WHEN p_size % 3 = 1 THEN 0.6 ELSE 0.5 END AS confidence FROM part")
def pattern_table(spark, sf):
    impact = F.when(F.col("p_size") % 3 == 0, "high").when(F.col("p_size") % 3 == 1, "low")
    return T.pattern_table(read(spark, sf, "part").select("p_partkey", F.col("p_name").alias("title"), impact.alias("impact")), "p_partkey")


@query("r06_map_variables", "SELECT p_partkey AS id, CASE p_size % 3 WHEN 0 THEN 'VH_mean,ndvi' WHEN 1 THEN 'swir_VAR_02' ELSE 'ndvi' END AS columns FROM part WHERE p_size % 4 <> 0")
def map_variables(spark, sf):
    p = read(spark, sf, "part")
    names = F.when(F.col("p_size") % 4 == 0, F.array(F.lit("none"))).when(F.col("p_size") % 3 == 0, F.array(F.lit("VH"), F.lit("gone"), F.lit("ndvi"))).when(F.col("p_size") % 3 == 1, F.array(F.lit("swir"))).otherwise(F.array(F.lit("ndvi")))
    out = T.map_variables(p.select(F.col("p_partkey").alias("id"), names.alias("variables")), ["VH_std", "VH_mean", "swir_cv", "swir_VAR_02", "ndvi", "ndvi_max"])
    return out.withColumn("columns", F.array_join("columns", ","))


@query("r07_append_failures", "SELECT p_partkey AS id, p_brand AS signature, p_size <= 25 AS stamped FROM part")
def append_failures(spark, sf):
    p = read(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("signature"), "p_size")
    old = p.filter("p_size > 25").select("id", "signature", F.lit(None).cast("timestamp").alias("failed_at"))
    return T.append_failures(old, p.filter("p_size <= 25").drop("p_size")).select("id", "signature", F.col("failed_at").isNotNull().alias("stamped"))
