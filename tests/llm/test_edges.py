"""Extra columns with clashing names, nulls and empty tables at every stage."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import minhash, mixing, toxicity
from tessera.llm.common import slices

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, key int, digest string, size int, class_id int, component int"
ROWS = [(i, t, "en", s, 1, "x", 1, "d", 1, 1, 1) for i, t, s in [(1, "a b c d e f g", "s"), (2, None, "s"), (3, "", None), (None, "a b c d e f g", "s"), (4, "a b c d e f g", None), (4, "a b c d e f g", None), (5, "long " * 40_000, "t"), (6, " \t\n", "t")]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_stages_keep_columns(spark, docs):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    kept = toxicity.clean_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    one = minhash.keep_one(kept)
    assert one.columns == docs.columns
    assert sorted((r.doc_id for r in one.collect()), key=str) == sorted([1, 2, 3, 5, 6, None], key=str)
    mixed = mixing.take(one)
    assert mixed.columns == docs.columns
    n = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert all(v <= 2 for v in n.values())
    packed = corpus_pipeline.pack_sequences(spark, mixed, "")
    assert packed.filter("piece = 0").count() == mixed.count()
    assert packed.agg(F.max("length")).first()[0] <= 2048


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for stage in (lambda d: toxicity.clean_documents(d, labels), minhash.keep_one, mixing.take):
        out = stage(none)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.pack_sequences(spark, none, "").count() == 0


def test_all_columns_null(spark):
    docs = spark.createDataFrame([(None,) * 5] * 3, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(None, None)], "doc_id long, toxic int")
    kept = mixing.take(minhash.keep_one(toxicity.clean_documents(docs, labels)))
    assert kept.count() <= 6


def test_slices_are_bounded_in_rows_and_text():
    texts = ["x" * n for n in (3, 0, 10, 50, 2, 2, 2, 2)] + [None]
    b = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], ["doc_id", "text"])
    got = [s["doc_id"].to_pylist() for s in slices([b, b.slice(5), b.slice(0, 0)], rows=3, most=13)]
    assert got == [[0, 1, 2], [3], [4, 5, 6], [7, 8], [5, 6, 7], [8]]
