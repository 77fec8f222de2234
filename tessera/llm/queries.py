"""Queries of the training-data operators, registered in __spark_entry__.py."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import ann, chat, decontaminate, embed_dedup, filter_audit, html_extract, lm_score, minhash, mixing, packing, resample, token_counts, toxicity
from tessera.llm.common import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), capacity=2048)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.filter(F.col("vec_id") % 20 == 0), k=20)


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows = rows.unionByName(spark.createDataFrame(own, "conv_id long, turn long, role string, text string"))
    return chat.read_back(chat.format_chat(rows))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, mix = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mixing.with_targets(found, mix)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classed(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a lasting cache if the session names one, else a new one
    cache = spark.conf.get("spark.tessera.tokenCache", None) or f"{shared_dir(spark).rstrip('/')}/token-cache-{uuid.uuid4().hex}"
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), cache, limit=512)


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, least_words=20, buckets=10_000, most=1, seed=2024)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _chat_sql() -> str:
    """Turns, digests and lengths worked out from the table alone."""

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def escaped(col: str) -> str:
        out = f"replace({col}, {quoted(chat.ESCAPE)}, {quoted(chat.ESCAPE * 2)})"
        for c in chat.CONTROL:
            out = f"replace({out}, {quoted(c)}, {quoted(c[0] + chat.ESCAPE + c[1:])})"
        return out

    marks = len(chat.TURN) + len(chat.BODY) + len(chat.END)
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
        count(*) OVER (PARTITION BY conv_id) AS all_turns,
        {marks} + length({escaped("role")}) + length({escaped("text")}) AS size FROM t),
s AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM n)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE role = 'assistant' OR k = all_turns) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id"""


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_source_mixing": op6_source_mixing,
    "op7_html_extraction": op7_html_extraction,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_token_counts": op10_token_counts,
    "op11_target_resampling": op11_target_resampling,
    "op12_decontamination": op12_decontamination,
    "op13_filter_audit": op13_filter_audit,
    "pipeline": pipeline,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: CRC-32 bit by bit over the bytes of each distinct word.
_RESAMPLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
f AS (SELECT r, unnest(words) AS word FROM d),
b AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM f UNION SELECT word FROM b)),
bucket AS (SELECT word, xor(list_reduce(list_transform(range(0, length(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT),
    lambda crc, byte: list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, byte)), 4294967295), 4294967295) % 10000 AS bucket FROM hexed),
s AS (SELECT bucket, count(*) AS s FROM f JOIN bucket USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN bucket USING (word) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT count(*) FROM f) + 10000) AS DOUBLE) / CAST((s + 1) * ((SELECT count(*) FROM b) + 10000) AS DOUBLE))) AS gain FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT r, floor(sum(gain) / count(*)) AS weight FROM f JOIN bucket USING (word) JOIN gain USING (bucket) GROUP BY r),
h AS (SELECT r, doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
    ('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN w USING (r)),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS score FROM h),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN rank <= (SELECT count(*) FROM placed) * 10 // 100 THEN rank END AS rank
FROM scored LEFT JOIN placed USING (r)"""

_DECONTAMINATION_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS words FROM benchmark),
run AS (SELECT item_id, words, least(len(words), 10) AS size, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS pos FROM i WHERE len(words) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(words[pos : pos + size - 1], ' ') AS text FROM run),
sizes AS (SELECT DISTINCT size FROM win),
place AS (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM d, sizes WHERE len(words) >= size),
hit AS (SELECT r, pos, p.size, item_id FROM (SELECT r, pos, size, array_to_string(words[pos : pos + size - 1], ' ') AS text FROM place) p JOIN win USING (size, text)),
word AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(pos, pos + size)) AS x FROM hit) GROUP BY r),
item AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN item USING (r)"""

_AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^ 	-
]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
  + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
  + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS fails
  FROM w LEFT JOIN l USING (doc_id)),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, (1 << (ascii(filter_order[step]) - 65)) AS own,
  coalesce(list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(filter_order[k]) - 65))), 0)::INT AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
c AS (SELECT part, filter_order, step, own,
  coalesce(sum(n) FILTER (fails & (before | own) = 0), 0) AS kept,
  coalesce(sum(n) FILTER (fails & own > 0 AND fails & before = 0), 0) AS removed,
  coalesce(sum(n) FILTER (fails & own > 0 AND fails & before > 0), 0) AS redundant,
  coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
  coalesce(sum(good) FILTER (fails & own > 0 AND fails & before = 0), 0) AS good_lost,
  coalesce(sum(toxic) FILTER (fails & own > 0 AND fails & before = 0), 0) AS toxic_lost
  FROM g, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM c"""

#: The others cannot be said in SQL; tests/llm holds them against brute force.
ORACLES = {"op5_chat_formatting": _chat_sql(), "op11_target_resampling": _RESAMPLE_SQL, "op12_decontamination": _DECONTAMINATION_SQL, "op13_filter_audit": _AUDIT_SQL}
