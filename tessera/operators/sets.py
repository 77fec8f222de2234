"""Set operations on splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def stack_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """One frame with column `split`; columns that a side lacks are null."""
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")), allowMissingColumns=True)


def append_pseudo(train: DataFrame, test: DataFrame, p: str = "p", y: str = "y", pos: float = 0.85, neg: float = 0.15, weight: float = 0.5) -> DataFrame:
    """Labelled rows of weight 1 and confident test rows, labelled by side, of `weight`."""
    from tessera.functions.scalar import confidence_label
    from tessera.operators.select import confident_rows

    labelled = train.withColumns({"weight": F.lit(1.0), "is_pseudo": F.lit(False)})
    sure = confident_rows(test, p, pos, neg).withColumn(y, confidence_label(p, max(pos, neg))).drop(*({p} - set(train.columns)))
    return labelled.unionByName(sure.withColumns({"weight": F.lit(weight), "is_pseudo": F.lit(True)}), allowMissingColumns=True)


def constant_in_both(train: DataFrame, test: DataFrame, protect=()) -> list[str]:
    """Columns with one distinct value, null included, in each of the two."""
    from tessera.operators.profile import constant_columns

    a, b = ({r[0] for r in constant_columns(x).collect()} for x in (train, test))
    return [c for c in train.columns if c in a & b and c not in protect]


def split_overlap(train: DataFrame, valid: DataFrame, key: str) -> DataFrame:
    """Ids in both; expected to be none."""
    return train.select(key).intersect(valid.select(key))
