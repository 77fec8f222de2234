"""Gates, blends and submissions on prediction and run tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tessera.operators import metrics as M
from tessera.operators.moments import pair_correlations
from tessera.operators.profile import flat, pearson, per_column


def _first(rules: list[tuple[Column, str]], default: str) -> Column:
    """Text of the first rule that holds."""
    return reduce(lambda out, r: F.when(r[0], r[1]).otherwise(out), reversed(rules), F.lit(default))


# ---- scores of branches


def fold_variance(scores: DataFrame, by=("branch",)) -> DataFrame:
    return scores.groupBy(*by).agg(F.avg("score").alias("mean"), F.var_samp("score").alias("variance"))


def distance(task: str = "task") -> Column:
    """1 - score of a classification, error over target deviation of a regression: lower is better."""
    return F.when(F.col(task) == "classification", 1 - F.col("score")).otherwise(F.try_divide(F.col("score"), F.col("target_std")))


def composite_fold_variance(scores: DataFrame, targets: DataFrame) -> DataFrame:
    """scores: branch, target, fold, score; targets: target, task, weight, target_std."""
    per = scores.join(targets, "target").groupBy("branch", "fold").agg((F.sum(F.col("weight") * distance()) / F.sum("weight")).alias("d"))
    return per.groupBy("branch").agg(F.avg("d").alias("mean"), F.var_samp("d").alias("variance"))


def composite_score(scores: DataFrame, targets: DataFrame) -> DataFrame:
    return scores.join(targets, "target").groupBy("branch").agg((F.sum(F.col("weight") * distance()) / F.sum("weight")).alias("composite"))


def seed_average(preds: DataFrame, by=("branch", "id")) -> DataFrame:
    return preds.groupBy(*by).agg(F.avg("pred").alias("pred"), F.count("*").alias("seeds"))


def positive_count_gate(preds: DataFrame, threshold: float, low: int | None, high: int | None, anchor: int | None) -> DataFrame:
    """Predicted positives within [low, high]; closed if a bound is not set."""
    n = preds.agg(F.count_if(F.col("p") >= threshold).alias("positives"))
    unset = low is None or high is None
    rules = [(F.lit(unset), "bounds unset"), (F.col("positives") < F.lit(low or 0), "too few"), (F.col("positives") > F.lit(high or 0), "too many")]
    reason = _first(rules, "ok")
    return n.select("positives", (F.col("positives") - F.lit(anchor).cast("long")).alias("drift"), (reason == "ok").alias("passed"), reason.alias("reason"))


def mean_abs_importance(shap: DataFrame, top: int = 15) -> DataFrame:
    """feature and importance (mean over folds of mean abs), share, rank, and the
    shares of the top features and of the tail."""
    from pyspark.sql.window import Window as W

    per = shap.groupBy("feature", "fold").agg(F.avg(F.abs("value")).alias("m")).groupBy("feature").agg(F.avg("m").alias("importance"))
    w = W.orderBy(F.desc("importance"), "feature")  # a row for each feature
    total = W.partitionBy()
    r = per.withColumns({"rank": F.row_number().over(w), "share": F.col("importance") / F.sum("importance").over(total)})
    head = F.sum(F.when(F.col("rank") <= top, F.col("share")).otherwise(0.0)).over(total)
    return r.withColumns({"top_share": head, "tail_share": 1 - head})


def dominance_leak(imp: DataFrame, confirm: DataFrame, t: float = 3.0) -> DataFrame:
    """imp: branch, feature, importance; confirm: branch, feature, task, r, nmi.
    The top feature is suspected if it is above `t` times the mean of the rest,
    and leaks if abs r >= .98 (regression) or NMI >= .90 as well."""
    per = imp.groupBy("branch").agg(F.sum("importance").alias("s"), F.count("*").alias("n"), F.max("importance").alias("top"), F.min_by("feature", F.struct(-F.col("importance"), "feature")).alias("feature"))
    ratio = F.try_divide(F.col("top"), (F.col("s") - F.col("top")) / F.when(F.col("n") > 1, F.col("n") - 1))
    out = per.withColumns({"ratio": ratio, "suspected": F.coalesce(ratio > t, F.lit(False))}).join(confirm, ["branch", "feature"], "left")
    sure = F.when(F.col("task") == "regression", F.abs("r") >= 0.98).otherwise(F.col("nmi") >= 0.90)
    return out.select("branch", "feature", "ratio", "suspected", (F.col("suspected") & F.coalesce(sure, F.lit(False))).alias("leaked"))


def prune_correlated(pairs: DataFrame, ranking: DataFrame) -> DataFrame:
    """Of each pair (a, b) the feature of larger rank goes."""
    r = lambda c: ranking.select(F.col("feature").alias(c), F.col("rank").alias(f"r_{c}"))
    both = pairs.join(r("a"), "a").join(r("b"), "b")
    return both.select(F.when(F.col("r_a") > F.col("r_b"), F.col("a")).otherwise(F.col("b")).alias("feature")).distinct()


def pruning_gate(runs: DataFrame) -> DataFrame:
    """runs: branch, task, full, pruned, target_std. F1 must rise by .005; RMSE
    must not rise by .01 deviations; multiclass passes."""
    delta = F.when(F.col("task") == "regression", F.col("full") - F.col("pruned")).otherwise(F.col("pruned") - F.col("full"))
    ok = F.when(F.col("task") == "multiclass", True).when(F.col("task") == "regression", delta >= -0.01 * F.col("target_std")).otherwise(delta >= 0.005)
    return runs.select("branch", delta.alias("delta"), ok.alias("passed"))


def leaked_union(by_target: DataFrame) -> DataFrame:
    """branch and its features that leak for any target."""
    flat = by_target.select("branch", F.explode("leaked").alias("feature")).distinct()
    return flat.groupBy("branch").agg(F.array_sort(F.collect_set("feature")).alias("features"))


# ---- gates


def effective_thresholds(runs: DataFrame) -> DataFrame:
    """Regression (not rmsle) thresholds in target units; deviation 0: raw, with a warning."""
    reg = (F.col("task") == "regression") & (F.col("metric") != "rmsle")
    scaled = reg & (F.coalesce("target_std", F.lit(0.0)) > 0)
    std = F.col("target_std")
    return runs.withColumns({
        "eff_variance": F.when(scaled, F.col("variance_limit") * std * std).otherwise(F.col("variance_limit")),
        "eff_margin": F.when(scaled, F.col("margin") * std).otherwise(F.col("margin")),
        "warning": reg & ~scaled,
    })


def baseline_for(runs: DataFrame) -> DataFrame:
    """baseline and baseline_source: augmented, challenged, plain, each by its
    generic score before that of the metric."""
    order = [f"{k}_{s}" for k in ("augmented", "challenged", "plain") for s in ("score", "metric_score")]
    source = _first([(F.col(c).isNotNull(), c) for c in order], "none")
    return runs.withColumns({"baseline": F.coalesce(*order), "baseline_source": source})


def improvement(direction: str = "direction") -> Column:
    return F.when(F.col(direction) == "maximize", F.col("score") - F.col("baseline")).otherwise(F.col("baseline") - F.col("score"))


def gate(runs: DataFrame) -> DataFrame:
    """verdict and the first check that fails. runs: branch, leaked, variance,
    eff_variance, baseline, score, direction, eff_margin, shap_passed, approved.
    Approval overrides variance, improvement and attribution."""
    free = ~F.coalesce("approved", F.lit(False))
    rules = [
        (F.coalesce("branch", F.lit("")) == "", "missing name"),
        (F.coalesce("leaked", F.lit(False)), "leaked feature"),
        (free & (F.col("variance").isNull() | (F.col("variance") >= F.col("eff_variance"))), "variance"),
        (F.col("baseline").isNull(), "no baseline"),
        (free & F.coalesce(improvement() <= F.col("eff_margin"), F.lit(True)), "improvement"),
        (free & ~F.coalesce("shap_passed", F.lit(False)), "attribution"),
    ]
    reason = _first(rules, "ok")
    return runs.withColumns({"reason": reason, "verdict": F.when(reason == "ok", "PASS").otherwise("FAIL")})


def gate_multi_target(runs: DataFrame, targets: DataFrame) -> DataFrame:
    """branch passes if pruning passed for every target and it is approved; with its composite."""
    ok = runs.groupBy("branch").agg((F.bool_and("pruning_passed") & F.bool_and("approved")).alias("passed"))
    return ok.join(composite_score(runs.select("branch", "target", "score"), targets), "branch")


def evaluate_variant(runs: DataFrame) -> DataFrame:
    """delta by direction; PASS if it reaches the margin, else PRUNE."""
    return runs.withColumns({"delta": improvement(), "verdict": F.when(improvement() >= F.col("margin"), "PASS").otherwise("PRUNE")})


def pseudo_guards(facts: DataFrame, pos: float = 0.85) -> DataFrame:
    """Six flags that must all hold before pseudo labels are used."""
    flags = {
        "is_classification": F.col("task") == "classification",
        "not_time": F.lower("cv_strategy") != "timeseriessplit",
        "no_leak": F.coalesce(F.col("leaked_features"), F.lit(0)) == 0,
        "stable": F.coalesce(F.col("variance") < F.col("eff_variance"), F.lit(False)),
        "calibrated": F.coalesce(F.col("calibrated"), F.lit(False)),
        "confident": F.coalesce(F.col("max_p") >= pos, F.lit(False)),
    }
    return facts.select("branch", *[e.alias(n) for n, e in flags.items()], reduce(lambda a, b: a & b, flags.values()).alias("all_hold"))


def recombine_targets(original: DataFrame, augmented: DataFrame, policy: str) -> DataFrame:
    """freeze: targets without augmented rows keep their original ones under the
    `_augmented` name. block: nothing unless each target was augmented."""
    have = augmented.select("branch", "target").distinct()
    missing = original.select(F.concat("branch", F.lit("_augmented")).alias("branch"), *[c for c in original.columns if c != "branch"]).join(have, ["branch", "target"], "left_anti")
    if policy == "freeze":
        return augmented.unionByName(missing.select(*augmented.columns))
    return augmented.join(missing.select("branch").distinct(), "branch", "left_anti")


def rollback_augmented(oof: DataFrame) -> DataFrame:
    return oof.filter(~F.col("branch").endswith("_augmented"))


def ensemble(members: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted mean of member probabilities for each id and fold."""
    w = members.join(F.broadcast(weights), "branch")  # a row for each branch
    return w.groupBy("id", "fold").agg((F.sum(F.col("weight") * F.col("p")) / F.sum("weight")).alias("p"), F.first("y").alias("y"))


# ---- fusion


def wide(oof: DataFrame, branches: list[str], value: str = "p") -> DataFrame:
    return oof.groupBy("id").pivot("branch", branches).agg(F.first(value))


def pair_correlation(oof: DataFrame, branches: list[str], task: str) -> DataFrame:
    """a, b and r: Pearson of probabilities, Spearman of regression values; none is 0."""
    if task == "regression":
        from tessera.operators.windows import average_rank

        oof = average_rank(oof.select("branch", "id", "p"), "p", ["branch"], "rank").withColumn("p", F.col("rank"))
    return pair_correlations(wide(oof, branches), branches).fillna(0.0, subset=["r"])


def prune_candidates(scores: dict[str, float], corr: list[tuple[str, str, float]], direction: str, limit: float = 0.95) -> list[str]:
    """Drop the worse of the first pair above the limit, the first on ties, until
    none is left. Works on branch names and pairs only."""
    left = list(scores)
    while True:
        hit = next(((a, b) for a, b, r in corr if a in left and b in left and abs(r) > limit), None)
        if hit is None:
            return left
        a, b = hit
        worse = scores[a] > scores[b] if direction == "minimize" else scores[a] < scores[b]
        left.remove(a if worse or scores[a] == scores[b] else b)


def blend(preds: DataFrame, branches: list[str]) -> DataFrame:
    """Unweighted mean over the branches for each id."""
    return preds.filter(F.col("branch").isin(branches)).groupBy("id").agg(F.avg("p").alias("p"), F.first("y").alias("y"))


def fuse(oof: DataFrame, task: str, metric: str, direction: str, top_n: int = 3, limit: float = 0.95) -> tuple[list[str], DataFrame]:
    """The branches of a pruned, ranked blend, and its out-of-fold predictions."""
    branches = sorted(r[0] for r in oof.select("branch").distinct().collect())
    scores = {r["branch"]: r["score"] for r in M.score(oof, task, metric, by=("branch",)).collect()}
    corr = [tuple(r) for r in pair_correlation(oof, branches, task).collect()]
    left = prune_candidates({b: scores[b] for b in branches}, corr, direction, limit)
    left.sort(key=lambda b: (-scores[b] if direction == "maximize" else scores[b], b))
    chosen = left[:top_n]
    return chosen, blend(oof, chosen)


def fuse_with_test(oof: DataFrame, test: DataFrame, task: str, metric: str, direction: str, anchor: float | None = None, top_n: int = 3, limit: float = 0.95, probabilities: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(oof, test, facts) of a pruned, ranked blend.

    test: branch, id and p of every branch; its blend is the mean over the same
    branches, with `value`: p, or for classes without probabilities the label by
    the blend's best threshold. facts: one row with the branches, the blend's
    score, that threshold (null with probabilities or for numbers), the anchor,
    delta (score less anchor) and whether that is better. An id that lacks a
    chosen branch on the test side is an error, as its mean would be of others."""
    chosen, blended = fuse(oof, task, metric, direction, top_n, limit)
    own = test.filter(F.col("branch").isin(chosen))
    mean = own.groupBy("id").agg(F.avg("p").alias("p"), F.count_distinct("branch").alias("_n"))
    short = F.when(F.col("_n") < len(chosen), F.raise_error(F.concat(F.lit("no prediction of some branch for "), F.col("id").cast("string"))).cast("double")).otherwise(F.col("p"))
    mean = mean.select("id", short.alias("p"))
    labels = task == "classification" and not probabilities
    cut = M.best_threshold(blended).select("threshold") if labels else oof.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"))
    value = (F.col("p") >= F.col("threshold")).cast("double") if labels else F.col("p")
    submitted = mean.crossJoin(F.broadcast(cut)).select("id", "p", value.alias("value"))
    better = F.col("delta") > 0 if direction == "maximize" else F.col("delta") < 0
    facts = M.score(blended, task, metric).crossJoin(cut).select(F.lit(",".join(sorted(chosen))).alias("branches"), "score", "threshold", F.lit(anchor).cast("double").alias("anchor"))
    return blended, submitted, facts.withColumn("delta", F.col("score") - F.col("anchor")).withColumn("better", F.coalesce(better, F.lit(False)))


def fuse_targets(oof: DataFrame, targets: list[dict], top_n: int = 3) -> DataFrame:
    """fuse() for each target, tagged; status PARTIAL when a target has no rows."""
    parts, missing = [], 0
    for t in targets:
        own = oof.filter(F.col("target") == t["name"])
        if not own.limit(1).count():
            missing += 1
            continue
        parts.append(fuse(own, t["task"], t["metric"], t["direction"], top_n)[1].withColumn("target", F.lit(t["name"])))
    status = "PARTIAL" if missing else "OK"
    return reduce(DataFrame.unionByName, parts).withColumn("status", F.lit(status))


# ---- submissions


def format_submission(pred: DataFrame, sample: DataFrame, key: str, values: list[str], task: str, threshold: float = 0.5, low=None, high=None, log: bool = False, probability: bool = True) -> DataFrame:
    """One row per sample row in its order. Two value columns: label and
    probability; one: either; regression: clipped (and log1p if asked)."""
    from tessera.functions import scalar as S

    if task == "classification":
        prob, label = S.clip_open("pred"), S.hard_label("pred", threshold)
        out = [label.alias(values[0]), prob.alias(values[1])] if len(values) == 2 else [(prob if probability else label).alias(values[0])]
    else:
        out = [S.submission_value("pred", low, high, log).alias(values[0])]
    return sample.select(key, "row_id").join(pred.select(key, "pred"), key, "left").select(key, "row_id", *out)


def validate_submission(sub: DataFrame, sample: DataFrame, key: str, values: list[str], kind: str = "probability", low=None, high=None) -> DataFrame:
    """issue and n of each check that fails: columns, row_count, extra_ids,
    missing_ids, duplicate_ids, order, nulls, not_finite, values. Both frames
    carry an explicit row_id."""
    from tessera.operators.select import names_frame

    columns = [c for c in sample.columns if c != "row_id"]
    own = [c for c in sub.columns if c != "row_id"]
    bad_columns = names_frame(sub, [("columns", len(set(columns) ^ set(own)))] if columns != own else [], "issue string, n long")
    one = lambda df, name, expr: df.agg(F.lit(name).alias("issue"), expr.cast("long").alias("n"))
    counts = sub.agg(F.count("*").alias("a")).crossJoin(sample.agg(F.count("*").alias("b")))
    parts = [
        bad_columns,
        counts.select(F.lit("row_count").alias("issue"), F.abs(F.col("a") - F.col("b")).cast("long").alias("n")),
        one(sub.join(sample, key, "left_anti"), "extra_ids", F.count("*")),
        one(sample.join(sub, key, "left_anti"), "missing_ids", F.count("*")),
        one(sub.groupBy(key).count().filter("count > 1"), "duplicate_ids", F.count("*")),
        one(sub.select(key, "row_id").join(sample.select(F.col(key).alias("_k"), "row_id"), "row_id").filter(~F.col(key).eqNullSafe(F.col("_k"))), "order", F.count("*")),
    ]
    have = [v for v in values if v in sub.columns]
    for v in have:
        x = F.col(v).cast("double")
        rule = {"probability": (x <= 0) | (x >= 1), "label": ~x.isin(0.0, 1.0)}.get(kind, F.coalesce(x < F.lit(low), F.lit(False)) | F.coalesce(x > F.lit(high), F.lit(False)))
        parts += [one(sub, "nulls", F.count_if(x.isNull())), one(sub, "not_finite", F.count_if(F.isnan(x) | (F.abs(x) == float("inf")))), one(sub, "values", F.count_if(rule))]
    return reduce(DataFrame.unionByName, parts).filter("n > 0")


def validate_many(subs: DataFrame, sample: DataFrame, key: str, value: str) -> DataFrame:
    """subs: file, id, value. A row for each file: rows, ids not in the sample,
    repeated ids, nulls, and whether a probability column holds labels only."""
    marked = subs.join(sample.select(key, F.lit(1).alias("_in")), key, "left")
    per = marked.groupBy("file").agg(F.count("*").alias("rows"), F.count_if(F.col("_in").isNull()).alias("extra"), F.count_if(F.col(value).isNull()).alias("nulls"), F.coalesce(F.bool_and(F.col(value).isin(0.0, 1.0)), F.lit(False)).alias("thresholded"))
    twice = subs.groupBy("file", key).count().groupBy("file").agg(F.count_if(F.col("count") > 1).alias("repeated"))
    return per.join(twice, "file").select("file", "rows", "extra", "repeated", "nulls", "thresholded", ((F.col("extra") == 0) & (F.col("repeated") == 0) & (F.col("nulls") == 0) & ~F.col("thresholded")).alias("ok"))


def variance_collapse_warning(pred: DataFrame, train: DataFrame, p: str, y: str, least: float = 0.1) -> DataFrame:
    a, b = per_column(pred, [p], lambda c: [("v", F.var_samp(c) * F.when(flat(c), 0.0).otherwise(1.0))]), per_column(train, [y], lambda c: [("w", F.when(~flat(c), F.var_samp(c)))])
    both = a.select("v").crossJoin(b.select("w"))
    return both.select((F.try_divide("v", "w")).alias("ratio"), (F.coalesce(F.try_divide("v", "w"), F.lit(0.0)) < least).alias("warning"))
