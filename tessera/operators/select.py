"""Projections, filters and column checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# Name parts that mark personal data, and place words.
PII = ("email", "phone", "name", "id_number", "ssn")
PLACE = ("spatial", "latitude", "longitude")
COORDINATES = ("latitude", "longitude", "lat", "lon", "lng")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def feature_columns(df: DataFrame, ids=(), targets=(), coords=COORDINATES, blocked=(), numeric_only=False) -> list[str]:
    """Columns left when ids, targets, coordinates and blocked ones go, in any case."""
    out = {c.lower() for group in (ids, targets, coords, blocked) for c in group}
    numeric = set(numeric_columns(df))
    return [c for c in df.columns if c.lower() not in out and (not numeric_only or c in numeric)]


def select_variant(df: DataFrame, variant: str, features: list[str], keep: list[str], columns: list[str] | None = None) -> DataFrame:
    """An explicit list, or by the name's last character: 0/7 the first half of
    the features, 1/8 the second, 2/9 every other, else all."""
    half, last = len(features) // 2, variant[-1:]
    if columns:
        chosen = [c for c in columns if c in df.columns]
    elif last and last in "07":
        chosen = features[:half]
    elif last and last in "18":
        chosen = features[half:]
    elif last and last in "29":
        chosen = features[::2]
    else:
        chosen = features
    return df.select(*keep, *chosen)


def drop_listed(df: DataFrame, dead: list[str], noise: list[str]) -> DataFrame:
    return df.drop(*dead, *noise)


def rename_columns(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in aliases.items() if a in df.columns})


def names_frame(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """Column metadata as a DataFrame; never row data."""
    return df.sparkSession.createDataFrame(rows, schema)


def schema_parity(train: DataFrame, test: DataFrame, target: str) -> DataFrame:
    """column and issue: missing_in_test, extra_in_test, target_missing."""
    a, b = set(train.columns), set(test.columns)
    low = target.lower()
    rows = [(c, "missing_in_test") for c in sorted(a - b) if c.lower() != low] + [(c, "extra_in_test") for c in sorted(b - a)]
    rows += [] if any(c.lower() == low for c in a) else [(target, "target_missing")]
    return names_frame(train, rows, "column string, issue string")


def policy_gate(df: DataFrame, banned: list[str]) -> DataFrame:
    """Banned columns that are present."""
    low = {b.lower() for b in banned}
    return names_frame(df, [(c,) for c in df.columns if c.lower() in low], "column string")


def pii_columns(df: DataFrame) -> DataFrame:
    return names_frame(df, [(c,) for c in df.columns if any(p in c.lower() for p in PII)], "column string")


def target_leak_guard(spec: dict, target: str) -> None:
    """Refuse a feature spec that uses the target anywhere but in its bins' mean."""
    used = list(spec.get("polynomials", []))
    used += [c for pair in [*spec.get("interactions", []), *spec.get("ratios", [])] for c in pair]
    used += [c["column"] for c in [*spec.get("conditions", []), *spec.get("target_dependent_bins", [])]]
    if target in used:
        raise ValueError(f"the feature spec uses the target {target}")


def validate_variant_lists(test: DataFrame, lists: dict[str, list[str]], target: str, dead: list[str], noise: list[str]) -> DataFrame:
    """variant, column and issue of each listed column that must not be there."""
    rows = []
    for variant, columns in lists.items():
        for c in columns:
            issue = "target" if c == target else "dead" if c in dead else "noise" if c in noise else "not_in_test" if c not in test.columns else ""
            rows += [(variant, c, issue)] if issue else []
    return names_frame(test, rows, "variant string, column string, issue string")


def flatten_plan(plan: DataFrame) -> DataFrame:
    """name, source, transform and columns of each planned feature; blanks get defaults."""
    item = plan.select(F.explode("features").alias("f"))
    return item.select(
        F.col("f.name").alias("name"),
        F.coalesce("f.source", F.lit("internal")).alias("source"),
        F.coalesce("f.transform", F.lit("none")).alias("transform"),
        F.coalesce("f.columns", F.array().cast("array<string>")).alias("columns"),
    )


def check_planned_features(plan: DataFrame, banned: list[str], place_ok: bool, listed: list[str]) -> DataFrame:
    """verdict and reason of each planned feature, the first rule that holds:
    external source, banned transform (whole token), place columns, unlisted source."""
    place = F.arrays_overlap(F.transform("columns", F.lower), F.array(*map(F.lit, COORDINATES)))
    rules = [
        (F.col("source") == "external", "BLOCK", "external source"),
        (F.lower("transform").isin(*[b.lower() for b in banned]), "BLOCK", "banned transform"),
        (place & F.lit(not place_ok), "BLOCK", "place columns"),
        (~F.col("source").isin(*listed), "WARN", "unlisted source"),
    ]
    verdict, reason = F.lit("PASS"), F.lit("ok")
    for test, v, r in reversed(rules):
        verdict, reason = F.when(test, v).otherwise(verdict), F.when(test, r).otherwise(reason)
    return plan.select("name", verdict.alias("verdict"), reason.alias("reason"))


def feature_policy(bans: str | Column, external: str | Column, automl: str | Column) -> list[Column]:
    """place_ok, external_ok and automl_ok from a list of ban tokens and two flags."""
    b = F.col(bans) if isinstance(bans, str) else bans
    placed = F.exists(b, lambda t: F.lower(t).rlike("|".join(PLACE)))
    return [(~F.coalesce(placed, F.lit(False))).alias("place_ok"), F.coalesce(external, F.lit(False)).alias("external_ok"), F.coalesce(automl, F.lit(False)).alias("automl_ok")]


def merge_banned(*lists: str | Column) -> Column:
    """Ordered union of ban lists without repeats and nulls."""
    full = [F.coalesce(F.col(x) if isinstance(x, str) else x, F.array().cast("array<string>")) for x in lists]
    return F.array_distinct(F.filter(F.concat(*full), lambda t: t.isNotNull()))


def bbox_filter(df: DataFrame, lat: str, lon: str, box: tuple[float, float, float, float]) -> DataFrame:
    """box: south, north, west, east, all inclusive."""
    return df.filter(F.col(lat).between(box[0], box[1]) & F.col(lon).between(box[2], box[3]))


def time_slice(df: DataFrame, ts: str, start, end) -> DataFrame:
    return df.filter(F.col(ts).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def confident_rows(df: DataFrame, p: str, pos: float = 0.85, neg: float = 0.15) -> DataFrame:
    pos, neg = max(pos, neg), min(pos, neg)
    return df.filter((F.col(p) >= pos) | (F.col(p) <= neg))


def complete_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows with both values, or none if there are not more than two."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    enough = both.agg((F.count("*") > 2).alias("_enough"))
    return both.crossJoin(F.broadcast(enough)).filter("_enough").drop("_enough")


def verified_candidates(oof: DataFrame, approvals: DataFrame, n_train: int, retraining: bool) -> DataFrame:
    """branch and rows of the approved branches of full length; `_augmented`
    ones only when retraining, and then only those."""
    sizes = oof.groupBy("branch").agg(F.count("*").alias("rows"))
    ends = F.col("branch").endswith("_augmented")
    return sizes.filter(F.col("rows") == n_train).filter(ends if retraining else ~ends).join(approvals.select("branch"), "branch", "left_semi")
