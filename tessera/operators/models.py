"""Cross-validated training, calibration and attribution.

Boosted trees of all folds grow side by side (`boosting`); forests and linear
models come from Spark ML, fold by fold over one cached frame. A model's
driver-side state is its trees or coefficients. Predictions stay in Spark as a
long table (id, fold, y, p or prob)."""

from __future__ import annotations

import json
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, IsotonicRegression, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from tessera.operators import metrics as M
from tessera.operators.boosting import ADDED_BYTES, Boosted, boost, few_blocks_a_batch, shap_values
from tessera.operators.profile import quantiles
from tessera.operators.transforms import median_fill_matrix, standardise
from tessera.sources.shared import new_path, spread, stored

#: Families of histogram boosting and what they learn by task.
BOOSTED = {"lgb", "xgb", "gbt", "poisson"}
OBJECTIVES = {"classification": "binary", "multiclass": "softmax", "regression": "squared"}
DEFAULTS = {"rf": {"numTrees": 500, "maxDepth": 12, "minInstancesPerNode": 2}, "lr": {"maxIter": 1000}, "glm": {"maxIter": 25}}


def make_model(family: str, task: str, params: dict | None = None, seed: int = 0, weight: str | None = None):
    """rf: forest; lr: (logistic) regression; glm: log-linear counts. Boosted trees
    (lgb, xgb, gbt, poisson) are not one estimator a fold: see `boosted`."""
    kind = family
    p = DEFAULTS[kind] | (params or {}) | {"featuresCol": "_x", "labelCol": "_y"} | ({"weightCol": weight} if weight else {})
    clf = task != "regression"
    if kind == "rf":
        return (RandomForestClassifier if clf else RandomForestRegressor)(**p, seed=seed, featureSubsetStrategy="sqrt")
    if kind == "glm":
        return GeneralizedLinearRegression(**p, family="poisson", link="log", regParam=1e-4)
    return (LogisticRegression if clf else LinearRegression)(**p)


def prepared(train: DataFrame, test: DataFrame, columns: list[str], y: str, scale: bool) -> tuple[DataFrame, DataFrame]:
    """Filled (and scaled) by the training rows, packed into _x, target in _y."""
    a, b = median_fill_matrix(train, test, columns)
    if scale:
        a, b = standardise(a, b, columns)
    pack = VectorAssembler(inputCols=columns, outputCol="_x")
    return pack.transform(a).withColumn("_y", F.col(y).cast("double")), pack.transform(b)


def fold_fits(train: DataFrame, columns: list[str], folds: list[int], scale: bool) -> dict[int, dict[str, tuple]]:
    """fold -> column -> (fill, mean, deviation) of its training side, as `prepared`
    fits them. Medians of all sides come from the same scans; moments from sums
    by fold, of which a side's are all less the fold's own. The number of scans
    hangs on that of columns times folds only by chunks of 100 expressions."""
    sides = [(f, c) for f in folds for c in columns]
    side = lambda f: (F.col("fold") != f) | F.col("_pseudo")
    fill = {}
    for at in range(0, len(sides), 100):
        fill |= quantiles(train, {(f, c): F.when(side(f), F.col(c)) for f, c in sides[at : at + 100]}, [0.5])
    fill = {k: v[0] if v[0] is not None else 0.0 for k, v in fill.items()}
    if not scale:
        return {f: {c: (fill[f, c], 0.0, 1.0) for c in columns} for f in folds}
    sums: dict = {}
    for at in range(0, len(columns), 30):
        own = columns[at : at + 30]
        x = {c: F.col(c).cast("double") - F.lit(float(fill[folds[0], c])) for c in own}
        parts = [F.count("*").alias("n"), *[e.alias(f"{k}{i}") for i, c in enumerate(own) for k, e in (("n", F.count(x[c])), ("s", F.sum(x[c])), ("q", F.sum(x[c] * x[c])))]]
        for r in train.groupBy("fold", "_pseudo").agg(*parts).collect():
            for i, c in enumerate(own):
                sums[r["fold"], r["_pseudo"], c] = np.array([r["n"], r[f"n{i}"], r[f"s{i}"] or 0.0, r[f"q{i}"] or 0.0])
    out: dict = {f: {} for f in folds}
    for f, c in sides:
        parts = [v for (g, pseudo, d), v in sums.items() if d == c and (pseudo or (g is not None and g != f))]
        rows, n, s, q = np.sum(parts, axis=0) if parts else np.zeros(4)
        shift = float(fill[folds[0], c])
        at = fill[f, c] - shift  # what its nulls become
        mean, square = (s + (rows - n) * at) / max(rows, 1), (q + (rows - n) * at * at) / max(rows, 1)
        spread = square - mean * mean
        out[f][c] = fill[f, c], mean + shift, float(np.sqrt(spread)) if spread > 1e-12 * square else 1.0
    return out


def fitted(df: DataFrame, fits: dict[str, tuple]) -> DataFrame:
    """df with its columns filled and scaled, packed into _x."""
    columns = {c: (F.coalesce(F.col(c).cast("double"), F.lit(float(fill))) - float(mean)) / float(spread) for c, (fill, mean, spread) in fits.items()}
    return VectorAssembler(inputCols=list(fits), outputCol="_x").transform(df.withColumns(columns))


def logistic(train: DataFrame, columns: list[str], y: str, fits: dict[int, dict[str, tuple]], most: int = 40) -> dict[int, tuple[float, list[float]]]:
    """fold -> (intercept, coefficients) of the logistic regression of y (0 or 1) on
    the filled and scaled columns of the fold's training side: Newton steps for
    all folds at once, each from one scan for the sums of loss, gradient and
    Hessian, of rows that are kept as blocks of bytes. A step that raises a fold's
    loss is halved.

    Folds with other or missing labels, with one class, with values that are not
    finite or without an end within `most` steps (classes that can be told apart
    wholly have none) are left out; all are if there are so many columns that the
    sums of all tasks are more than the driver should add up."""
    weight = F.col("weight") if "weight" in train.columns else F.lit(1.0)
    label = F.col(y).cast("double")
    names = [f"_c{i}" for i in range(len(columns))]
    every = train.filter("fold IS NOT NULL OR _pseudo").select(F.when(~F.col("_pseudo"), F.col("fold")).cast("int").alias("_f"), F.when(label.isin(0.0, 1.0), label).alias("_y"), weight.cast("double").alias("_w"), *[F.col(c).cast("double").alias(n) for c, n in zip(columns, names)])
    width = len(columns) + 1
    size = 1 + width + width * width + 2  # loss, gradient, Hessian, weights of both classes
    if 2 * train.sparkSession.sparkContext.defaultParallelism * len(fits) * size * 8 > ADDED_BYTES:
        return {}

    def packed(batches):
        for b in batches:
            values = [x.to_numpy(zero_copy_only=False).astype("float64") for x in (b["_f"].fill_null(-1), *b.columns[1:])]
            void = [x.is_null().to_numpy(zero_copy_only=False) for x in b.columns[3:]] if any(x.null_count for x in b.columns[3:]) else []
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(x.tobytes() for x in part)], pa.binary()) for part in (values, void)], ["rows", "void"])

    def opened(b, k):
        values = np.frombuffer(b["rows"][k].as_buffer(), "float64").reshape(len(names) + 3, -1)
        void = np.frombuffer(b["void"][k].as_buffer(), "bool").reshape(len(names), -1) if len(b["void"][k].as_buffer()) else [None] * len(names)
        return (*values[:3], values[3:], void)

    blocks = every.mapInArrow(packed, "rows binary, void binary").cache()
    own_fits = {f: np.array([fits[f][c] for c in columns], float).reshape(-1, 3) for f in fits}
    at, steps, best, out = {f: np.zeros(width) for f in fits}, {}, {f: (np.inf, np.zeros(width)) for f in fits}, {}

    def scanned(live: list[int]) -> np.ndarray:
        now = [(f, at[f], own_fits[f]) for f in live]

        def run(batches):
            total = np.zeros((len(now), size))
            for fold, y, weight, values, void in (opened(b, k) for b in batches for k in range(b.num_rows)):
                for sums, (f, w, fit) in zip(total, now):
                    inside = fold != f
                    x, label, u = np.ones((width, np.count_nonzero(inside))), y[inside], weight[inside]
                    for row, v, gone, (fill, mean, spread) in zip(x[1:], values, void, fit):
                        np.subtract((v if gone is None else np.where(gone, fill, v))[inside], mean, out=row)
                        row /= spread
                    z = w @ x
                    small = np.exp(-np.abs(z))
                    q = np.where(z >= 0, 1, small) / (1 + small)
                    sums[0] += u @ (np.maximum(z, 0) + np.log1p(small) - label * z)
                    sums[1 : 1 + width] += x @ (u * (q - label))
                    sums[1 + width : -2] += ((x * (u * q * (1 - q))) @ x.T).ravel()
                    sums[-2:] += u @ (1 - label), u @ label
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        return sum(np.frombuffer(r[0]).reshape(-1, size) for r in blocks.mapInArrow(run, "sums binary").collect())

    try:
        blocks.count()
        with few_blocks_a_batch(train.sparkSession):
            live = list(fits)
            for _ in range(most):
                found = scanned(live)
                left = []
                for f, sums in zip(live, found):
                    loss, slope, bend, classes = sums[0], sums[1 : 1 + width], sums[1 + width : -2].reshape(width, width), sums[-2:]
                    if not np.isfinite(sums).all() or classes.min() <= 0 or loss < 1e-6 * classes.sum():
                        continue
                    if loss > best[f][0] + 1e-9 * abs(best[f][0]):
                        steps[f] = steps[f] / 2
                        at[f] = best[f][1] + steps[f]
                    else:
                        # columns that say nothing more than others get the least coefficients
                        best[f], steps[f] = (loss, at[f]), -np.linalg.lstsq(bend, slope, rcond=1e-12)[0]
                        at[f] = at[f] + steps[f]
                    if np.abs(steps[f]).max() > 1e-6 * (1 + np.abs(at[f]).max()):
                        left.append(f)
                    else:
                        out[f] = float(at[f][0]), [float(w) for w in at[f][1:]]
                live = left
                if not live:
                    break
    finally:
        blocks.unpersist()
    return out


def probability(fit: tuple[float, list[float]], fits: dict[str, tuple]) -> Column:
    """P(1) of a row by a `logistic` fit, filled and scaled as the fold's rows were."""
    z = F.lit(fit[0])
    for w, (c, (fill, mean, spread)) in zip(fit[1], fits.items()):
        z = z + F.lit(w) * (F.coalesce(F.col(c).cast("double"), F.lit(float(fill))) - float(mean)) / float(spread)
    return 1 / (1 + F.exp(-z))


def predicted(model, df: DataFrame, task: str, keep: list[str]) -> DataFrame:
    out = model.transform(df)
    if task == "regression":
        return out.select(*keep, F.col("prediction").alias("p"))
    prob = vector_to_array("probability")
    return out.select(*keep, prob[1].alias("p")) if task == "classification" else out.select(*keep, prob.alias("prob"))


def sides(train: DataFrame, folds: list[int]) -> DataFrame:
    """`train` once for each fold's model, with model and valid: pseudo-labelled
    rows (_pseudo) train every model and validate none, and so do rows with a
    negative fold; rows without a fold take no part."""
    every = train.filter("fold IS NOT NULL OR _pseudo").withColumn("model", F.explode(F.array(*map(F.lit, folds))))
    return every.withColumn("valid", F.coalesce((F.col("fold") == F.col("model")) & ~F.col("_pseudo"), F.lit(False)))


def fold_ids(train: DataFrame) -> list[int]:
    return sorted(r[0] for r in train.filter("NOT _pseudo").select("fold").distinct().collect() if r[0] is not None and r[0] >= 0)


def boosted(train: DataFrame, columns: list[str], y: str, task: str, family: str = "lgb", params: dict | None = None) -> Boosted:
    """A boosted model for each fold of `train` (fold, _pseudo and perhaps weight),
    stopped early by its validation rows; by default 500 rounds at rate 0.05, 31
    leaves, patience 50. family poisson: counts with a log link; else binary,
    softmax or squared error by task. Nulls go the better way at each split."""
    objective = "poisson" if family == "poisson" else OBJECTIVES[task]
    classes = int(train.agg(F.max(F.col(y).cast("int"))).first()[0]) + 1 if objective == "softmax" else 1
    rows = train if "model" in train.columns else sides(train, fold_ids(train))
    weight = F.col("weight") if "weight" in train.columns else F.lit(1.0)
    return boost(rows.select("model", "valid", F.col(y).alias("y"), weight.alias("weight"), *columns), columns, objective, classes, params)


def _boosted_cv(train, test, columns, y, task, family, key, params, features):
    folds = fold_ids(train)
    if not features:
        fit = boosted(train, columns, y, task, family, params)
        own = train.filter(F.col("fold").isin(folds) & ~F.col("_pseudo"))
        return fit.predict(own, [key, "fold", y], "fold"), fit.predict(test, [key])
    fits, tests = [], []
    for f in folds:
        learn, valid = train.filter((F.col("fold") != f) | F.col("_pseudo")), train.filter((F.col("fold") == f) & ~F.col("_pseudo"))
        a, both = features(learn, valid.withColumn("_v", F.lit(True)).unionByName(test.withColumn("_v", F.lit(False)), allowMissingColumns=True), f)
        fits.append(a.withColumns({"model": F.lit(f), "valid": F.lit(False)}).unionByName(both.filter("_v").drop("_v").withColumns({"model": F.lit(f), "valid": F.lit(True)}), allowMissingColumns=True))
        tests.append(both.filter("NOT _v").withColumn("model", F.lit(f)))
    rows = stored(reduce(DataFrame.unionByName, fits), "folds")[0]
    fit = boosted(rows, columns, y, task, family, params)
    return fit.predict(rows.filter("valid"), [key, "fold", y], "model"), fit.predict(reduce(DataFrame.unionByName, tests), [key], "model")


def train_cv(train: DataFrame, test: DataFrame, columns: list[str], y: str, task: str, family: str = "gbt", key: str = "id", params: dict | None = None, seed: int = 0, features=None) -> tuple[DataFrame, DataFrame]:
    """(oof, test) predictions, both written once in the shared folder. `train` has
    a fold column; each fold's transform and model see its training side only,
    pseudo-labelled rows among it. Boosted trees stop early on the validation
    fold. `features`: callable (train, test, fold) -> both with more columns. Test
    predictions are the mean over folds."""
    return train_seeds(train, test, columns, y, task, family, key, params, [seed], features)[0]


def train_seeds(train: DataFrame, test: DataFrame, columns: list[str], y: str, task: str, family: str, key: str, params: dict | None, seeds: list[int], features=None) -> list[tuple[DataFrame, DataFrame]]:
    """`train_cv` for each seed. All share one spread table and the fits of each fold's
    transform; boosted trees draw nothing at random and are trained once for all."""
    pseudo = F.col("is_pseudo") if "is_pseudo" in train.columns else F.lit(False)
    train = train.withColumn("_pseudo", pseudo)
    if not features:  # rows carry what is used, nothing else
        train = train.select(*dict.fromkeys([key, "fold", y, "_pseudo", *(["weight"] if "weight" in train.columns else []), *columns]))
        test = test.select(*dict.fromkeys([key, *columns]))
    train, test = spread(train, key).cache(), spread(test, key).cache()

    def kept(oof: DataFrame, every: DataFrame) -> tuple[DataFrame, DataFrame]:
        if task != "multiclass":
            mean = every.groupBy(key).agg(F.avg("p").alias("p"))
        else:
            flat = every.select(key, F.posexplode("prob").alias("c", "v")).groupBy(key, "c").agg(F.avg("v").alias("v"))
            mean = flat.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("c", "v"))), lambda s: s.v).alias("prob"))
        return stored(oof.withColumnRenamed(y, "y"), "oof")[0], stored(mean, "test")[0]

    try:
        if family in BOOSTED:
            return [kept(*_boosted_cv(train, test, columns, y, task, family, key, params, features))] * len(seeds)
        parts: dict[int, list] = {s: [] for s in seeds}
        scale, folds = family in ("lr", "glm"), fold_ids(train)
        fits = {} if features or not folds else fold_fits(train, columns, folds, scale)
        # logistic regressions of all folds come from the same scans; Spark ML fits what that leaves out
        joint = logistic(train, columns, y, fits) if fits and (family, task) == ("lr", "classification") and not params else {}
        if joint:
            p = {f: probability(joint[f], fits[f]) for f in joint}
            own = train.filter(F.col("fold").isin(list(joint)) & ~F.col("_pseudo")).select(key, "fold", y, F.coalesce(*[F.when(F.col("fold") == f, c) for f, c in p.items()]).alias("p"))
            for s in seeds:
                parts[s].append((own, test.select(key, F.explode(F.array(*p.values())).alias("p"))))
        for f in [f for f in folds if f not in joint]:
            fit, valid = train.filter((F.col("fold") != f) | F.col("_pseudo")), train.filter((F.col("fold") == f) & ~F.col("_pseudo"))
            both = valid.withColumn("_v", F.lit(True)).unionByName(test.withColumn("_v", F.lit(False)), allowMissingColumns=True)
            if features:
                fit, both = features(fit, both, f)
                a, b = prepared(fit, both, columns, y, scale)
            else:
                a, b = fitted(fit, fits[f]).withColumn("_y", F.col(y).cast("double")), fitted(both, fits[f])
            for s in seeds:
                model = make_model(family, task, params, s, "weight" if "weight" in train.columns else None).fit(a)
                parts[s].append((predicted(model, b.filter("_v"), task, [key, "fold", y]), predicted(model, b.filter("NOT _v"), task, [key])))
        return [kept(*(reduce(DataFrame.unionByName, side) for side in zip(*parts[s]))) for s in seeds]
    finally:
        train.unpersist()
        test.unpersist()


def multi_seed(train: DataFrame, test: DataFrame, columns: list[str], y: str, task: str, family: str = "gbt", key: str = "id", seed: int = 0, n: int = 3, params: dict | None = None, features=None) -> tuple[DataFrame, DataFrame]:
    """Means over seeds seed, seed + 1, .. of the predictions, not of scores."""
    runs = train_seeds(train, test, columns, y, task, family, key, params, [seed + i for i in range(n)], features)
    oof = reduce(DataFrame.unionByName, (r[0] for r in runs)).groupBy(key, "fold", "y").agg(F.avg("p").alias("p"))
    return oof, reduce(DataFrame.unionByName, (r[1] for r in runs)).groupBy(key).agg(F.avg("p").alias("p"))


def train_targets(train: DataFrame, test: DataFrame, columns: list[str], targets: list[dict], key: str = "id", **more) -> tuple[DataFrame, DataFrame]:
    """An independent run for each target over the same folds, other targets out
    of the features."""
    names = {t["name"] for t in targets}
    own = [c for c in columns if c not in names]
    runs = [(t["name"], train_cv(train, test, own, t["name"], t["task"], t.get("family", "gbt"), key, **more)) for t in targets]
    tag = lambda df, n: df.withColumn("target", F.lit(n))
    return reduce(DataFrame.unionByName, (tag(r[0].withColumn("y", F.col("y").cast("double")), n) for n, r in runs)), reduce(DataFrame.unionByName, (tag(r[1], n) for n, r in runs))


def compare_runs(first: DataFrame, second: DataFrame, task: str, metric: str) -> DataFrame:
    """Score of two runs of one model side by side, and the difference."""
    a, b = (M.score(x, task, metric).withColumnRenamed("score", n) for x, n in ((first, "original"), (second, "challenger")))
    return a.crossJoin(b).withColumn("delta", F.col("challenger") - F.col("original"))


def pseudo_label(train: DataFrame, test: DataFrame, columns: list[str], y: str, key: str = "id", pos: float = 0.85, neg: float = 0.15, rounds: int = 5, seed: int = 0, seeds: int = 3, state: str | None = None, params: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Rounds of confident test rows added to each training side, labelled by the
    round before; boosted trees and forest half and half, forests averaged over
    `seeds` seeds (the trees draw nothing at random, so they have one run); weight
    (1 - p)/p on positives. Stops from round 2 on when F1 does not rise; returns
    the best round's oof and a row of facts for each round: its F1 and the pseudo
    rows that it learned from.

    Each round writes its predictions below `state` (default: a new folder in the
    shared one) and is then committed to a log there. A run that is started again
    with the same `state` goes on behind the last committed round, with the same
    result; with other columns or parameters it is refused."""
    from tessera.operators.sets import append_pseudo
    from tessera.sources.commits import CommitLog

    spark = train.sparkSession
    log = CommitLog(spark, state := state or new_path(spark, "pseudo"))
    about = {"columns": list(columns), "y": y, "key": key, "pos": pos, "neg": neg, "seed": seed, "seeds": seeds, "params": params}
    history = [e for _, e in log.entries()]
    if any(e["about"] != json.loads(json.dumps(about)) for e in history):
        raise ValueError(f"{state} holds rounds of another run")
    share = train.agg(F.avg(F.col(y).cast("double"))).first()[0]
    boost_by = (1 - share) / share if share else 1.0
    weighted = lambda df: df.withColumn("weight", F.coalesce("weight", F.lit(1.0)) * F.when(F.col(y) == 1, boost_by).otherwise(1.0))

    def kept(parts: list[tuple[float, DataFrame]], by: list[str], name: str) -> str:
        path = f"{state.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        every = reduce(DataFrame.unionByName, (df.withColumn("p", w * F.col("p")) for w, df in parts))
        every.groupBy(*by).agg(F.sum("p").alias("p")).write.parquet(path)
        return path

    def over() -> bool:
        scores = [e["f1"] for e in history]
        return bool(history) and (len(history) > rounds or not history[-1]["added"] or (len(history) > 2 and scores[-1] <= max(scores[:-1])))

    while not over():
        if history:
            now = append_pseudo(train, test.join(spark.read.parquet(history[-1]["guess"]), key), "p", y, pos, neg).withColumn("fold", F.coalesce("fold", F.lit(-1)))
        else:
            now = train.withColumns({"weight": F.lit(1.0), "is_pseudo": F.lit(False)})
        now = stored(spread(weighted(now), key), "learned")[0]  # read by every run of the round
        fit = lambda family, s: train_cv(now, test, columns, y, "classification", family, key, (params or {}).get(family), s)
        runs = [(0.5, fit("gbt", seed)), *[(0.5 / seeds, fit("rf", seed + i)) for i in range(seeds)]]
        oof, guess = kept([(w, r[0]) for w, r in runs], [key, "fold", "y"], "oof"), kept([(w, r[1]) for w, r in runs], [key], "guess")
        sure = append_pseudo(train, test.join(spark.read.parquet(guess), key), "p", y, pos, neg).filter("is_pseudo").count()
        entry = {"kind": "round", "about": about, "f1": float(M.best_threshold(spark.read.parquet(oof)).first()["f1"]), "added": sure, "learned": history[-1]["added"] if history else 0, "oof": oof, "guess": guess}
        if not log.put(len(history) + 1, entry):
            raise RuntimeError(f"another run writes rounds to {state}")
        history.append(entry)
    best = max(history, key=lambda e: e["f1"])  # the first of the best
    facts = [(r, e["f1"], e["learned"]) for r, e in enumerate(history)]
    return spark.read.parquet(best["oof"]), spark.createDataFrame(facts, "round int, f1 double, pseudo_rows long")


def screen_hypotheses(hyp: DataFrame, df: DataFrame, y: str) -> DataFrame:
    """id, stage and reason; kept if both null. Static: columns known, unique and
    not empty. Empirical: not all null, mean mutual information above 0, and a
    small boosted model gains from one of them."""
    from tessera.operators.profile import mutual_information

    known = F.array(*map(F.lit, df.columns))
    static = F.when(F.size("columns") == 0, "empty").when(F.size(F.array_except("columns", known)) > 0, "unknown column").when(F.size(F.array_distinct("columns")) < F.size("columns"), "repeated column")
    h = hyp.withColumn("static", static)
    used = sorted(r[0] for r in h.filter("static IS NULL").select(F.explode("columns")).distinct().collect())
    if not used:
        return h.select("id", F.when(F.col("static").isNotNull(), "static").alias("stage"), F.col("static").alias("reason"))
    df = stored(spread(df.select(y, *[c for c in used if c != y])), "screened")[0]
    fit = boost(df.select(F.lit(0).alias("model"), F.lit(False).alias("valid"), F.col(y).alias("y"), F.lit(1.0).alias("weight"), *used), used, params={"rounds": 5})
    split = {used[c] for trees in fit.rounds.get(0, []) for t in trees for c in t.feature[t.feature >= 0].tolist()}
    rows = {c: float(c in split) for c in used}
    nulls = df.agg(*[(F.count(c) == 0).alias(c) for c in used]).first()
    mi = {r["column"]: r["mi"] for r in mutual_information(df, used, y).collect()}
    facts = hyp.sparkSession.createDataFrame([(c, bool(nulls[c]), float(mi[c]), rows[c]) for c in used], "column string, void boolean, mi double, gain double")
    per = h.filter("static IS NULL").select("id", F.explode("columns").alias("column")).join(F.broadcast(facts), "column").groupBy("id").agg(F.bool_and("void").alias("void"), F.avg("mi").alias("mi"), F.max("gain").alias("gain"))
    reason = F.coalesce("static", F.when(F.col("void"), "all null").when(F.col("mi") <= 1e-12, "no information").when(F.col("gain") <= 0, "no gain"))
    stage = F.when(F.col("static").isNotNull(), "static").when(reason.isNotNull(), "empirical")
    return h.join(per, "id", "left").select("id", stage.alias("stage"), reason.alias("reason"))


# ---- calibration


def _platt(rows: DataFrame, sides: dict[int | None, Column], classes: list[tuple[Column, Column]]) -> dict:
    """(side, class) -> (slope, intercept) of the logistic regression of y on p, with
    half the squared slope as penalty: Newton steps for all sides and classes at
    once, each from one scan for six sums a fit. A step that raises a fit's loss
    is halved."""
    names = [f"{n}{k}" for k in range(len(classes)) for n in "yp"]
    flat = rows.select(*[F.coalesce(c, F.lit(False)).alias(f"_s{i}") for i, c in enumerate(sides.values())], *[c.cast("double").alias(n) for n, c in zip(names, (c for pair in classes for c in pair))]).dropna()
    fits = [(f, i, k) for i, f in enumerate(sides) for k in range(len(classes))]
    at, steps, best = {m: np.zeros(2) for m in fits}, {m: np.zeros(2) for m in fits}, {m: (np.inf, np.zeros(2)) for m in fits}
    live = list(fits)
    for _ in range(100):
        now = [(i, k, *map(float, at[f, i, k])) for f, i, k in live]

        def run(batches, now=now):
            sums = np.zeros((len(now), 6))
            for b in batches:
                values = {c: b[c].to_numpy(zero_copy_only=False) for c in b.schema.names}
                for own, (i, k, w, c) in zip(sums, now):
                    y, p = (values[f"{n}{k}"][values[f"_s{i}"]] for n in "yp")
                    z = w * p + c
                    small = np.exp(-np.abs(z))
                    q = np.where(z >= 0, 1, small) / (1 + small)
                    g, h = q - y, q * (1 - q)
                    own += (np.maximum(z, 0) + np.log1p(small) - y * z).sum(), (g * p).sum(), g.sum(), (h * p * p).sum(), (h * p).sum(), h.sum()
            yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

        found = sum(np.frombuffer(r[0]).reshape(-1, 6) for r in flat.mapInArrow(run, "sums binary").collect())
        left = []
        for m, (loss, gw, gb, ww, wb, bb) in zip(live, found):
            w, loss = at[m][0], loss + at[m][0] ** 2 / 2
            if loss > best[m][0] + 1e-9 * abs(best[m][0]):
                steps[m] = steps[m] / 2
                at[m] = best[m][1] + steps[m]
            else:
                best[m], steps[m] = (loss, at[m]), -np.linalg.solve([[ww + 1, wb], [wb, bb + 1e-12]], [gw + w, gb])
                at[m] = at[m] + steps[m]
            if np.abs(steps[m]).max() > 1e-9 * (1 + np.abs(at[m]).max()):
                left.append(m)
        live = left
        if not live:
            break
    return {(f, k): tuple(map(float, at[f, i, k])) for f, i, k in fits}


def _isotonic(rows: DataFrame, sides: dict[int | None, Column], classes: list[tuple[Column, Column]]) -> dict:
    """(side, class) -> (boundaries, values) of the isotonic regression of y on p."""
    out = {}
    for f, inside in sides.items():
        for k, (y, p) in enumerate(classes):
            fit = rows.filter(inside).select(p.cast("double").alias("p"), y.cast("double").alias("_y"), F.lit(1.0).alias("weight"))
            model = IsotonicRegression(featuresCol="p", labelCol="_y").fit(fit)
            out[f, k] = model.boundaries.toArray(), model.predictions.toArray()
    return out


def _at(fit, p: Column, method: str) -> Column:
    """p by a fitted map; isotonic ends are clipped."""
    if method == "platt":
        return 1 / (1 + F.exp(-(F.lit(fit[0]) * p + F.lit(fit[1]))))
    x, v = fit

    @F.pandas_udf("double")
    def at(p):
        import pandas as pd

        return pd.Series(np.interp(p.to_numpy(), x, v))

    return at(p)


def _calibrated(oof: DataFrame, test: DataFrame, classes: list[tuple[Column, Column]], method: str, put) -> tuple[DataFrame, DataFrame]:
    """Each fold by maps fitted on the other folds, test by maps fitted on all; a side
    with one class only passes through. classes: (y, p) of each, fitted from the
    same scans. put: (df, column of each class) -> df."""
    fit = {"platt": _platt, "isotonic": _isotonic}[method]
    oof, _ = stored(spread(oof), "to-calibrate")  # read for each fold
    folds = sorted(r[0] for r in oof.select("fold").distinct().collect())
    sides = {None: F.lit(True)} | {f: F.col("fold") != f for f in folds}
    ends = [F.max(F.when(inside, y)).alias(f"h{i}_{k}") for i, inside in enumerate(sides.values()) for k, (y, _) in enumerate(classes)]
    ends += [F.min(F.when(inside, y)).alias(f"l{i}_{k}") for i, inside in enumerate(sides.values()) for k, (y, _) in enumerate(classes)]
    found = oof.agg(*ends).first()
    open_ = {(f, k) for i, f in enumerate(sides) for k in range(len(classes)) if found[f"l{i}_{k}"] is not None and found[f"l{i}_{k}"] != found[f"h{i}_{k}"]}
    fits = {}
    for k in range(len(classes)):
        own = {f: c for f, c in sides.items() if (f, k) in open_}
        same = [j for j in range(len(classes)) if {f for f in sides if (f, j) in open_} == set(own)]
        if own and k == same[0]:
            fits |= {(f, same[j]): v for (f, j), v in fit(oof, own, [classes[j] for j in same]).items()}
    new = lambda f: [_at(fits[f, k], p, method) if (f, k) in fits else p for k, (_, p) in enumerate(classes)]
    parts = [put(oof.filter(F.col("fold") == f), new(f)) for f in folds]
    return reduce(DataFrame.unionByName, parts) if parts else oof, put(test, new(None))


def calibrate(oof: DataFrame, test: DataFrame, method: str = "platt") -> tuple[DataFrame, DataFrame]:
    """Each fold by a map fitted on the other folds, test by one fitted on all.
    A side with one class only passes through; none: as it is."""
    if method == "none":
        return oof, test
    return _calibrated(oof, test, [(F.col("y"), F.col("p"))], method, lambda df, p: df.withColumn("p", p[0]))


def calibrate_multiclass(oof: DataFrame, test: DataFrame, classes: int, method: str = "platt", key: str = "id") -> tuple[DataFrame, DataFrame]:
    """One-vs-rest for each class, then rows normalised. A single probability
    column stands for [1 - p, p]."""
    from tessera.functions.scalar import normalise_rows

    if "prob" not in oof.columns:
        oof, test = (df.withColumn("prob", F.array(1 - F.col("p"), F.col("p"))).drop("p") for df in (oof, test))
    put = lambda df, p: df.withColumn("prob", F.array(*p)).withColumn("prob", normalise_rows("prob"))
    own = [((F.col("y") == c).cast("int"), F.col("prob")[c]) for c in range(classes)]
    if method == "none":
        return put(oof, [p for _, p in own]), put(test, [p for _, p in own])
    return _calibrated(oof, test, own, method, put)


# ---- attribution


def shap_linear(train: DataFrame, columns: list[str], y: str, task: str, key: str = "id") -> DataFrame:
    """fold, id, feature and exact linear attribution w (x - mean) on the log-odds
    or value scale, on validation rows only, as plain expressions."""
    parts = []
    train = stored(spread(train, key), "shap")[0]
    folds = sorted(r[0] for r in train.select("fold").distinct().collect())
    for f in folds:
        fit, valid = train.filter(F.col("fold") != f), train.filter(F.col("fold") == f)
        a, b = median_fill_matrix(fit, valid, columns)
        a, b = standardise(a, b, columns)  # training means are 0
        model = make_model("lr", task).fit(VectorAssembler(inputCols=columns, outputCol="_x").transform(a).withColumn("_y", F.col(y).cast("double")))
        w = [float(x) for x in model.coefficients]
        values = b.select(key, "fold", *[(F.lit(w[i]) * F.col(c)).alias(c) for i, c in enumerate(columns)])
        parts.append(values.unpivot([key, "fold"], columns, "feature", "value"))
    return reduce(DataFrame.unionByName, parts)


def shap_trees(train: DataFrame, columns: list[str], y: str, task: str, key: str = "id", params: dict | None = None, family: str = "lgb") -> DataFrame:
    """fold, id, feature and exact tree attribution of the validation rows of each
    fold, by that fold's boosted trees, on the score's scale (of the last class)."""
    train = stored(spread(train.withColumn("_pseudo", F.lit(False)), key), "shap")[0]
    fit = boosted(train, columns, y, task, family, params)
    return shap_values(fit, train, key, "fold")


def shap_audit(train: DataFrame, columns: list[str], y: str, task: str, key: str = "id", family: str = "lgb", params: dict | None = None) -> DataFrame:
    """Mean abs attribution a feature, on validation rows; exact for trees and, with
    family lr, for linear models. Fewer than two features skip the ratio audit."""
    from tessera.operators.gates import mean_abs_importance

    values = shap_linear(train, columns, y, task, key) if family == "lr" else shap_trees(train, columns, y, task, key, params, family)
    return mean_abs_importance(values).withColumn("audited", F.lit(len(columns) >= 2))
