"""Sources and sinks: tables, features, predictions, submissions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark orders NaN above all numbers; here a missing value is always null."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if isinstance(k, (T.DoubleType, T.FloatType)) else F.col(c) for c, k in kinds.items()])


def read_table(spark: SparkSession, path: str, schema=None, columns: list[str] | None = None) -> DataFrame:
    """Parquet, ORC, JSON, or CSV with a header. A schema spares the inference pass."""
    kind = next((k for k in ("csv", "json", "orc") if re.search(rf"\.{k}(\.gz)?/?$", path)), "parquet")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if kind == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    df = reader.format(kind).load(path)
    return nan_to_null(df.select(*columns) if columns else df)


def load_manifest(spark: SparkSession, folder: str, files: dict[str, str]) -> dict[str, DataFrame]:
    """The tables of a manifest that exist; the store is asked, not the local disk."""
    conf, found = spark._jsc.hadoopConfiguration(), {}
    for name, file in files.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{file}")
        if path.getFileSystem(conf).exists(path):
            found[name] = read_table(spark, f"{folder}/{file}")
    return found


def mask_to_null(df: DataFrame, value: float = -9999) -> DataFrame:
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    return df.select(*[F.nullif(F.col(c), F.lit(value).cast(df.schema[c].dataType)).alias(c) if c in numeric else F.col(c) for c in df.columns])


def write_features(df: DataFrame, path: str, branch: str) -> None:
    """Append one branch; only that branch's partition is replaced on a rerun."""
    df.withColumn("branch", F.lit(branch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("branch").parquet(path)


def write_predictions(df: DataFrame, path: str, branch: str, target: str, kind: str) -> None:
    """kind: oof or test."""
    tagged = df.withColumns({"branch": F.lit(branch), "target": F.lit(target), "kind": F.lit(kind)})
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "branch", "target").parquet(path)


def write_submission(df: DataFrame, folder: str, suffix: str, order_by: str) -> str:
    """One ordered CSV `sub_NNN_suffix`, NNN one above the largest there. Spark's
    commit protocol shows it whole or not at all."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    last = max((int(m[1]) for m in (re.match(r"sub_(\d+)_", n) for n in names) if m), default=0)
    out = f"{folder}/sub_{last + 1:03d}_{suffix}"
    df.orderBy(order_by).coalesce(1).write.option("header", True).csv(out)
    return out


def artifact_manifest(preds: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows and an order-free content hash of each artifact."""
    return preds.groupBy(*keys).agg(F.count("*").alias("n_rows"), content_hash(columns).alias("content_hash"))


def content_hash(columns: list[str]):
    """Sum over rows of the first 32 bits of the md5 of the joined values: the
    same in any order, and one partial aggregate."""
    row = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.sum(F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("long"))


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), content_hash(columns).alias("content_hash"))


def verify_fingerprint(current: DataFrame, locked: DataFrame) -> DataFrame:
    """table_name and status: ok, changed, missing or new."""
    now = current.select("table_name", F.struct("n_rows", "content_hash").alias("now"))
    then = locked.select("table_name", F.struct("n_rows", "content_hash").alias("then"))
    status = F.when(F.col("then").isNull(), "new").when(F.col("now").isNull(), "missing").when(F.col("now") == F.col("then"), "ok").otherwise("changed")
    return now.join(then, "table_name", "full").select("table_name", status.alias("status"))
