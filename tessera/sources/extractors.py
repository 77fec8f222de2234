"""Feature extractors by name: callables (spark, inputs, config) that return the
train and test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Extractor = Callable[[SparkSession, dict[str, DataFrame], dict], tuple[DataFrame, DataFrame]]
_registered: dict[str, Extractor] = {}


def register(name: str) -> Callable[[Extractor], Extractor]:
    def keep(f: Extractor) -> Extractor:
        if name in _registered:
            raise ValueError(f"an extractor {name} exists")
        _registered[name] = f
        return f

    return keep


def extract(name: str, spark: SparkSession, inputs: dict[str, DataFrame], config: dict) -> tuple[DataFrame, DataFrame]:
    """Run an extractor; the two tables must share their feature columns."""
    if name not in _registered:
        raise KeyError(f"no extractor {name}; there are {sorted(_registered)}")
    train, test = _registered[name](spark, inputs, config)
    missing = set(train.columns) - set(test.columns) - {config.get("target")}
    if missing:
        raise ValueError(f"the test table lacks {sorted(missing)}")
    return train, test


@register("entity_aggregates")
def entity_extractor(spark: SparkSession, inputs: dict[str, DataFrame], config: dict) -> tuple[DataFrame, DataFrame]:
    """Accounts enriched by per-key aggregates of fact tables.

    inputs: base and the tables of config["facts"], a list of {table, measures};
    config: key, target and split, a condition that marks training rows."""
    from tessera.operators.joins import enrich
    from tessera.operators.profile import entity_aggregates

    key, facts = config["key"], []
    for fact in config["facts"]:
        agg = entity_aggregates(inputs[fact["table"]], key, fact["measures"])
        facts.append((agg.withColumnRenamed("n", f"{fact['table']}_n"), key))
    full = enrich(inputs["base"], facts, protect=(config.get("target"),))
    train = full.filter(F.expr(config["split"]))
    test = full.filter(~F.coalesce(F.expr(config["split"]), F.lit(False)))
    return train, test.drop(config["target"]) if config.get("target") else test
