"""Column functions of the tabular workflow, all JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# How metrics are named, which way they improve and what they need.
MAXIMISE = ("auc", "f1", "accuracy", "precision", "recall", "r2", "map", "kappa", "mcc", "gini")
PROBABILITY = ("auc", "log_loss", "logloss", "brier", "gini")
REGRESSION = ("rmse", "mae", "mse", "rmsle", "mape", "r2", "poisson")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def polynomial(c: str) -> Column:
    return (F.col(c) * F.col(c)).cast("double").alias(f"{c}_sq")


def interaction(a: str, b: str) -> Column:
    return (F.col(a) * F.col(b)).cast("double").alias(f"{a}_x_{b}")


def ratio(a: str, b: str) -> Column:
    """Null when the shifted denominator is exactly zero."""
    return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double") + F.lit(1e-9)).alias(f"{a}_div_{b}")


def condition(c: str, op: str, value: float, name: str) -> Column:
    """1.0 where c is below (lt), above (gt) or equal (eq); any other operator is 0.0 everywhere."""
    tests = {"lt": F.col(c) < value, "gt": F.col(c) > value, "eq": F.col(c) == value}
    hit = tests.get(op)
    return (F.lit(0.0) if hit is None else F.when(hit, 1.0).otherwise(0.0)).alias(name)


def clip(c: str | Column, low=None, high=None) -> Column:
    out = col(c)
    out = out if low is None else F.greatest(out, F.lit(low))
    return out if high is None else F.least(out, F.lit(high))


def target_transform(c: str | Column, metric: str) -> Column:
    """Training scale: log1p for rmsle, floor at 0 for poisson, else as it is."""
    return F.log1p(col(c)) if metric == "rmsle" else clip(c, 0.0) if metric == "poisson" else col(c)


def inverse_transform(c: str | Column, metric: str, low=None, high=None) -> Column:
    if metric == "rmsle":
        return F.expm1(clip(c, 0.0))
    return clip(c, 0.0) if metric == "poisson" else clip(c, low, high)


def clip_open(c: str | Column, eps: float = 1e-7) -> Column:
    return clip(c, eps, 1 - eps)


def hard_label(c: str | Column, threshold: float = 0.5) -> Column:
    return F.when(col(c) >= threshold, 1).otherwise(0)


def submission_value(c: str | Column, low=None, high=None, log: bool = False) -> Column:
    out = clip(c, low, high)
    return F.log1p(out) if log else out


def argmax_class(prob: str | Column) -> Column:
    """Index of the largest probability, the first on ties."""
    return (F.array_position(col(prob), F.array_max(col(prob))) - 1).cast("int")


def normalise_rows(prob: str | Column) -> Column:
    total = F.aggregate(col(prob), F.lit(0.0), lambda a, x: a + x)
    return F.transform(col(prob), lambda x: x / F.when(total == 0, 1.0).otherwise(total))


def unit_sphere(lat: str, lon: str) -> list[Column]:
    a, o = F.radians(lat), F.radians(lon)
    return [(F.cos(a) * F.cos(o)).alias("x"), (F.cos(a) * F.sin(o)).alias("y"), F.sin(a).alias("z")]


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return F.asin(F.sqrt(F.least(F.lit(1.0), h))) * 2 * 6371.0088


def year_from_key(key: str | Column, default: int) -> Column:
    """Second dashed part of the first underscored part."""
    part = F.get(F.split(F.get(F.split(col(key), "_"), F.lit(0)), "-"), F.lit(1))
    return F.coalesce(part.try_cast("int"), F.lit(default))


def to_number(c: str | Column) -> Column:
    """Double, or null for text that is no number, NaN and infinities."""
    x = col(c).try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def normalise_token(c: str | Column) -> Column:
    return F.regexp_replace(F.replace(F.lower(F.trim(col(c))), F.lit("-"), F.lit("_")), r" +", "_")


def strip_strategy_prefix(c: str | Column) -> Column:
    return F.regexp_replace(col(c), "^((config|override):)+", "")


def mentions(text: str | Column, words: list[str]) -> Column:
    """The keywords that occur in the text, in list order."""
    low = F.lower(col(text))
    return F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(low, w))


def classify_text(text: str | Column, ban: str, clarify: str) -> Column:
    """ban before clarify before question, by regular expression."""
    low = F.lower(col(text))
    return F.when(low.rlike(ban), "ban").when(low.rlike(clarify), "clarify").otherwise("question")


def build_comment(branch: Column, oof: Column, features: Column, calib: Column) -> Column:
    return F.concat(F.lit("branch:"), branch, F.lit("|oof:"), oof.cast("string"), F.lit("|features:"), features.cast("string"), F.lit("|calib:"), calib)


def parse_comment(c: str | Column) -> Column:
    return F.str_to_map(col(c), F.lit("[|]"), F.lit(":"))


def band_month(name: str | Column) -> list[Column]:
    """BAND_MM -> band and month; both null without a digit suffix."""
    ok = col(name).rlike("^.+_[0-9]+$")
    band = F.when(ok, F.regexp_replace(col(name), "_[0-9]+$", ""))
    return [band.alias("band"), F.when(ok, F.regexp_extract(col(name), "_([0-9]+)$", 1).cast("int")).alias("month")]


def metric_facts(metric: str | Column) -> list[Column]:
    """task, needs_probability and direction of a metric's name."""
    low = F.lower(col(metric))
    any_of = lambda names: low.rlike("|".join(names))
    return [
        F.when(any_of(REGRESSION), "regression").otherwise("classification").alias("task"),
        any_of(PROBABILITY).alias("needs_probability"),
        F.when(any_of(MAXIMISE), "maximize").otherwise("minimize").alias("direction"),
    ]


def impact_confidence(c: str | Column) -> Column:
    low = F.lower(col(c))
    return F.when(low == "high", 0.9).when(low == "medium", 0.75).when(low == "low", 0.6).otherwise(0.5)


def preview(c: str | Column, n: int) -> Column:
    return F.substring(col(c), 1, n)


def missing_indicator(c: str) -> Column:
    return F.col(c).isNull().cast("int").alias(f"{c}_is_missing")


def confidence_label(c: str | Column, positive: float = 0.85) -> Column:
    return F.when(col(c) >= positive, 1).otherwise(0)


def signature_of(columns: str | Column, transformation: str | Column) -> Column:
    return F.concat(F.concat_ws("|", F.array_sort(col(columns))), F.lit("::"), col(transformation))
