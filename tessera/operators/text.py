"""Text jobs over stored tables: threads, rules, literature, hypotheses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window as W

# Patterns of competition rules in page text.
RULES = {
    "metric": r"(?i)(?:evaluat\w+ (?:metric|by)|metric)[^a-z]{1,20}(rmsle|rmse|mae|auc|f1|log ?loss|accuracy)",
    "daily_limit": r"(?i)(\d+) submissions? (?:per|a) day",
    "split_percent": r"(?i)(\d{1,3}) ?% of the test",
    "team_size": r"(?i)teams? of (?:up to|at most) (\d+)",
    "prize": r"(?i)\$ ?(\d[\d,]*)",
    "deadline": r"(\d{4}-\d{2}-\d{2})",
}
PERMISSIONS = {"automl_allowed": r"(?i)automl (?:is )?(?:allowed|permitted)", "external_allowed": r"(?i)external data (?:is )?(?:allowed|permitted)"}
#: What a mapped variable's column may end in, in order of preference.
SUFFIXES = [f"_VAR_{m:02d}" for m in range(1, 13)] + ["_last3mo_mean", "_mean", "_std", "_min", "_max", "_cv", "_range"]


def flag_threads(posts: DataFrame, comments: DataFrame, words: list[str], watched: list[str], organisers: list[str], ban: str, clarify: str) -> DataFrame:
    """Threads with a keyword in title, body or a comment, or by a watched author:
    class, flagged comments, source links and whether an organiser answered.

    posts: thread_id, title, body, author; comments: thread_id, body, author."""
    from tessera.functions.scalar import classify_text, mentions

    hit = F.size(mentions("body", words)) > 0
    link = F.regexp_extract_all(F.col("body"), F.lit(r"(https?://[^\s\"<>]+)"), F.lit(1))
    c = comments.groupBy("thread_id").agg(
        F.count_if(hit).alias("flagged_comments"),
        F.bool_or(F.col("author").isin(organisers)).alias("resolved"),
        F.array_distinct(F.flatten(F.collect_list(F.when(F.size(link) > 0, link)))).alias("links"),
    )
    text = F.concat_ws(" ", "title", "body")
    p = posts.join(c, "thread_id", "left").withColumn("flagged_comments", F.coalesce("flagged_comments", F.lit(0)))
    kept = p.filter((F.size(mentions(text, words)) > 0) | (F.col("flagged_comments") > 0) | F.col("author").isin(watched))
    own = F.regexp_extract_all(F.col("body"), F.lit(r"(https?://[^\s\"<>]+)"), F.lit(1))
    return kept.select("thread_id", classify_text(text, ban, clarify).alias("cls"), "flagged_comments", F.array_sort(F.array_distinct(F.concat(own, F.coalesce("links", F.array().cast("array<string>"))))).alias("sources"), F.coalesce("resolved", F.lit(False)).alias("resolved"))


def carry_overrides(flags: DataFrame, previous: DataFrame, key: str = "source_url") -> DataFrame:
    """Manual `superseded` marks of an earlier run survive."""
    return flags.join(previous.select(key, "superseded"), key, "left").withColumn("superseded", F.coalesce("superseded", F.lit(False)))


def extract_rules(pages: DataFrame, text: str) -> DataFrame:
    """A column for each rule found in the text, null if absent."""
    got = lambda p: F.nullif(F.regexp_extract(F.col(text), p, 1), F.lit(""))
    out = {k: got(p) for k, p in RULES.items()}
    out["metric"] = F.lower(out["metric"])
    out |= {k: out[k].try_cast("int") for k in ("daily_limit", "split_percent", "team_size")}
    out["prize"] = F.replace(out["prize"], F.lit(","), F.lit("")).try_cast("long")
    out["deadline"] = F.try_to_date(out["deadline"], "yyyy-MM-dd")
    return pages.withColumns(out | {k: F.col(text).rlike(p) for k, p in PERMISSIONS.items()})


def tag_literature(docs: DataFrame, key: str, text: str, signals: dict[str, list[str]], top: int = 16) -> DataFrame:
    """Keyword signals of each document, labels and variables joined; the first
    document by key of each (labels, variables), at most `top` of them. A
    keyword table is a literal, so tagging is one projection."""
    low = F.lower(F.col(text))
    tags = F.array_compact(F.array(*[F.when(F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(low, w)), F.lit(label)) for label, words in signals.items()]))
    used = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(low, w)) for words in signals.values()]))))
    tagged = docs.select(key, F.array_join(tags, ", ").alias("labels"), F.array_join(used, ",").alias("variables")).filter("labels <> ''")
    return tagged.groupBy("labels", "variables").agg(F.min(key).alias(key)).orderBy(key).limit(top)


def pattern_table(ideas: DataFrame, order: str) -> DataFrame:
    """Numbered pattern rows with a confidence by stated impact."""
    from tessera.functions.scalar import impact_confidence
    from tessera.operators.ledger import numbered

    n = numbered(ideas, "number", [order])
    return n.select(F.format_string("P%05d", "number").alias("pattern"), "title", impact_confidence("impact").alias("confidence"))


def map_variables(hyp: DataFrame, columns: list[str]) -> DataFrame:
    """id and the columns its abstract variables map to: the first suffix in
    order that exists. Unmapped variables go, and with them empty hypotheses."""
    spark = hyp.sparkSession
    have = spark.createDataFrame([(c,) for c in columns], "column string")  # column names only
    steps = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(s).alias("s")) for i, s in enumerate(["", *SUFFIXES])])
    long = hyp.select("id", F.posexplode("variables").alias("at", "variable")).withColumn("_s", F.explode(steps))
    named = long.withColumn("column", F.concat("variable", "_s.s")).join(F.broadcast(have), "column")
    one = named.groupBy("id", "at").agg(F.min_by("column", "_s.k").alias("column"))
    return one.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "column"))), lambda x: x.column).alias("columns"))


def append_failures(ledger: DataFrame, failed: DataFrame) -> DataFrame:
    """Stamped failures behind the ledger, signatures kept."""
    return ledger.unionByName(failed.withColumn("failed_at", F.current_timestamp()), allowMissingColumns=True)


def threads_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Posts (turn 0) and comments of the conversations table."""
    c = conversations.filter("turn >= 0")
    posts = c.filter("turn = 0").select(F.col("conv_id").alias("thread_id"), F.substring("text", 1, 40).alias("title"), F.col("text").alias("body"), F.col("role").alias("author"))
    return posts, c.filter("turn > 0").select(F.col("conv_id").alias("thread_id"), F.col("text").alias("body"), F.col("role").alias("author"))


def stripped(html: str):
    """Markup out, white space folded: enough for rule patterns."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col(html), r"(?is)<(script|style)\b.*?</\1>", " "), r"<[^>]*>", " "), r"\s+", " "))


def first_per_group(df: DataFrame, by: list[str], order: str, k: int) -> DataFrame:
    return df.withColumn("_k", F.row_number().over(W.partitionBy(*by).orderBy(order))).filter(F.col("_k") <= k).drop("_k")
