"""Registration of queries with their SQL, and inputs said once for both."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; `sql` is the DuckDB text for the same rows."""

    def keep(f):
        assert name not in QUERIES, name
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


@dataclass(frozen=True)
class Input:
    """A projection of one driver table in expressions that both engines read."""

    table: str
    columns: tuple[str, ...]
    where: str = "true"

    def df(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return read(spark, sf_dir, self.table).where(self.where).selectExpr(*self.columns)

    @property
    def sql(self) -> str:
        return f"(SELECT {', '.join(self.columns)} FROM {self.table} WHERE {self.where})"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Inputs used by many queries. No driver table holds nulls, so some are put in.
LINES = Input("lineitem", ("l_orderkey * 8 + l_linenumber AS id", "l_quantity AS qty", "l_extendedprice AS price", "l_discount AS disc", "l_tax AS tax", "l_returnflag AS flag", "CAST(l_linenumber AS INT) AS line"))
HOLES = Input(
    "part",
    (
        "p_partkey AS id",
        "CAST(nullif(p_size, 7) AS DOUBLE) AS size",
        "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice END AS price",
        "CASE WHEN p_size > 40 THEN NULL ELSE p_partkey % 17 END AS code",
        "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_brand END AS brand",
        "CAST(CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS INT) AS y",
        "1.0 AS one",
    ),
)
#: Predictions of three branches: y, probability p, regression value v, fold and group.
PREDS = Input(
    "orders",
    (
        "o_orderkey AS id",
        "CONCAT('b', CAST(o_orderkey % 3 AS STRING)) AS branch",
        "CAST(floor(o_orderkey / 3) % 5 AS INT) AS fold",
        "CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INT) AS y",
        "0.05 + (o_custkey % 11) / 25 + (o_orderkey % 9) / 20 + CASE WHEN o_orderstatus = 'F' THEN 0.1 ELSE 0.0 END AS p",
        "1.0 + floor(o_totalprice) % 50 AS v",
        "(1.0 + floor(o_totalprice) % 50) * (0.9 + (o_orderkey % 11) / 100) AS v_hat",
    ),
)
#: Runs of an experiment ledger, a row per order of one status.
RUNS = Input(
    "orders",
    (
        "o_orderkey AS experiment_id",
        "CONCAT('b', CAST(o_custkey % 7 AS STRING)) AS branch_name",
        "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE floor(o_totalprice / 10) / 10000 END AS oof_score",
        "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE floor(o_totalprice / 9) / 10000 END AS oof_rmse",
        "CASE WHEN o_orderstatus = 'F' THEN 'PASS' WHEN o_orderstatus = 'O' THEN 'FAIL' ELSE 'PENDING' END AS gate_result",
        "o_orderdate AS created_at",
    ),
)
