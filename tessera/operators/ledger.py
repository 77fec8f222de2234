"""Experiment and submission ledgers: Parquet files under a log of commits, and their queries."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window as W

from tessera.sources.commits import CommitLog
from tessera.sources.shared import stored

EXPERIMENTS = """experiment_id long, branch_name string, oof_score float, oof_rmse float, metric string, calibration string, gate_result string,
 n_features int, seed int, cv_strategy string, approved_by string, notes string, created_at timestamp"""
SUBMISSIONS = """submission_id long, experiment_id long, filename string, public_score float, private_score float, rank int, is_final boolean,
 comment string, status string, board_id string, created_at timestamp"""


def numbered(rows: DataFrame, key: str, order: list[str], start: int = 0) -> DataFrame:
    """Ids above `start` in a fixed order. Range partitions are numbered apart
    and shifted by the sizes of those before, so no task sees all rows. They are
    written first: sizes and rows of two runs of the plan need not agree on where
    partitions begin (sampling, coalescing by width)."""
    tagged = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), "numbered")[0]
    sizes = tagged.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    shift = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n") - F.col("_first")).alias("_shift"))
    return tagged.join(F.broadcast(shift), "_part").withColumn(key, F.col("_row") + F.col("_shift") + 1 + start).drop("_part", "_row", "_shift", "_n")


def complete_experiments(df: DataFrame) -> DataFrame:
    """The rmse alias fills a missing score and names the metric."""
    metric = F.coalesce("metric", F.when(F.col("oof_score").isNull() & F.col("oof_rmse").isNotNull(), "rmse")) if "metric" in df.columns else F.when(F.col("oof_score").isNull() & F.col("oof_rmse").isNotNull(), "rmse")
    return df.withColumn("metric", metric).withColumn("oof_score", F.coalesce("oof_score", "oof_rmse"))


def _files(df: DataFrame) -> list[dict]:
    """Where the numbers of each written file begin and end."""
    at = F.col("_metadata.file_path")
    return [{"file": r["f"], "first": r["a"], "last": r["z"]} for r in df.groupBy(at.alias("f")).agg(F.min("_k").alias("a"), F.max("_k").alias("z")).collect()]


def _written(rows: DataFrame, path: str) -> list[dict]:
    """`rows`, with a number _k each, clustered by it in new files."""
    spark, to = rows.sparkSession, f"{path.rstrip('/')}/data/{uuid.uuid4().hex}"
    rows.repartitionByRange("_k").sortWithinPartitions("_k").write.parquet(to)
    return _files(spark.read.schema(rows.schema).parquet(to))


def _part(spark: SparkSession, n: int, entry: dict, schema: str, files: list[dict] | None = None) -> DataFrame | None:
    """Rows of one commit, with their ids and version."""
    files = entry["files"] if files is None else files
    if not files:
        return None
    key = schema.split()[0]
    rows = spark.read.schema(f"_k long, {schema}").parquet(*[f["file"] for f in files])
    version = entry["upto"] if entry["kind"] == "compact" else n
    return rows.withColumn(key, F.col("_k") + F.lit(entry["base"])).withColumn("version", F.lit(version).cast("long"))


def _newest(spark: SparkSession, parts: list[tuple[str, DataFrame]], schema: str) -> DataFrame:
    """Rows by id, changed ones as they were changed last. Only changes are
    grouped; other rows are unique by their numbers."""
    key = schema.split()[0]
    names = spark.createDataFrame([], schema).columns
    changed = [df for kind, df in parts if kind == "update"]
    plain = [df.select(*names) for kind, df in parts if kind != "update"]
    if not plain:
        return spark.createDataFrame([], schema)
    rows = reduce(DataFrame.unionByName, plain)
    if not changed:
        return rows
    last = reduce(DataFrame.unionByName, changed).groupBy(key).agg(F.max_by(F.struct(*names), "version").alias("r")).select("r.*")
    return rows.join(last.select(key), key, "left_anti").select(*names).unionByName(last)


def read_ledger(spark: SparkSession, path: str, schema: str, upto: int | None = None) -> DataFrame:
    """All rows as of one commit (default: the newest), each as it was changed last.
    Commits that come later do not show, whenever the rows are read."""
    parts = [(e["kind"], _part(spark, n, e, schema)) for n, e in CommitLog(spark, path).entries(upto)]
    return _newest(spark, [(k, df) for k, df in parts if df is not None], schema)


def read_one(spark: SparkSession, path: str, schema: str, key: int) -> DataFrame:
    """The row of one id: reads the file of its commit that holds the id and those
    of changes that may, and in them the row groups whose numbers reach it."""
    parts = []
    for n, e in CommitLog(spark, path).entries():
        own = [f for f in e["files"] if f["first"] <= key - e["base"] <= f["last"]]
        if own:
            parts.append((e["kind"], _part(spark, n, e, schema, own).filter(F.col("_k") == key - e["base"])))
    return _newest(spark, parts, schema)


def append(df: DataFrame, path: str, schema: str, order: list[str]) -> None:
    """Number and stamp new rows and append them as one commit. Rows are written
    with numbers of their own first; the commit that takes the next place in the
    log says what to add to them, so writers at once never share an id, and one
    that comes second only asks for the next place."""
    spark = df.sparkSession
    fields = spark.createDataFrame([], schema).schema.fields
    rows = numbered(df, "_k", order)
    stamped = rows.withColumn("created_at", F.coalesce("created_at", F.current_timestamp()) if "created_at" in rows.columns else F.current_timestamp())
    full = [(F.col(f.name) if f.name in stamped.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    files = _written(stamped.select("_k", *full), path)
    most = max((f["last"] for f in files), default=0)
    log = CommitLog(spark, path)
    while True:
        n, top = log.last(), 0
        for _, e in log.entries(n):
            top = max(top, e.get("top", 0))
        if log.put(n + 1, {"kind": "append", "base": top, "top": top + most, "files": files}):
            return


def log_experiments(df: DataFrame, path: str, order: list[str]) -> None:
    append(complete_experiments(df), path, EXPERIMENTS, order)


def log_submissions(df: DataFrame, path: str, order: list[str]) -> None:
    append(df, path, SUBMISSIONS, order)


def apply_changes(ledger: DataFrame, key: str, changes: DataFrame) -> DataFrame:
    """The ledger with the non-null fields of `changes` by id."""
    fields = [c for c in changes.columns if c != key]
    new = changes.select(key, *[F.col(c).alias(f"_{c}") for c in fields])
    return ledger.join(new, key, "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in fields else F.col(c) for c in ledger.columns])


def update_ledger(spark: SparkSession, path: str, schema: str, changes: DataFrame) -> None:
    """Commit new versions of the changed rows. If others have changed rows since
    the state that this change was worked out from, it is worked out again; new
    rows of others do not matter to it."""
    log = CommitLog(spark, path)
    while True:
        seen = log.last()
        now = read_ledger(spark, path, schema, seen)
        key = now.columns[0]
        rows = apply_changes(now, key, changes).join(changes, key, "left_semi")
        files = _written(rows.withColumn("_k", F.col(key)).select("_k", *now.columns), path)
        n = seen
        while not log.put(n + 1, {"kind": "update", "base": 0, "files": files}):
            n += 1
            if log._read(log._name(n))["kind"] == "update":
                break
        else:
            return


def compact_ledger(spark: SparkSession, path: str, schema: str) -> None:
    """Write the state of now as one set of files clustered by id. Commits behind it
    stay as they are, so writers need not wait; readers of earlier states still
    find their files."""
    log = CommitLog(spark, path)
    seen = log.last()
    if not seen:
        return
    now = read_ledger(spark, path, schema, seen)
    files = _written(now.withColumn("_k", F.col(now.columns[0])).select("_k", *now.columns), path)
    top = max(e.get("top", 0) for _, e in log.entries(seen))
    n = seen
    while not log.put(n + 1, {"kind": "compact", "base": 0, "upto": seen, "top": top, "files": files}):
        n += 1


def backfill(board: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paired experiment and submission rows of a board, by default passed and
    without calibration."""
    b = numbered(board, "experiment_id", ["created_at", "id"])
    exp = b.select("experiment_id", F.col("filename").alias("branch_name"), F.col("public_score").alias("oof_score"), F.lit("PASS").alias("gate_result"), F.lit("none").alias("calibration"), "created_at")
    sub = b.select(F.col("experiment_id").alias("submission_id"), "experiment_id", "filename", "public_score", F.coalesce("chosen", F.lit(False)).alias("is_final"), "created_at")
    return exp, sub


def _scored(exp: DataFrame) -> DataFrame:
    return exp.withColumn("score", F.coalesce("oof_score", "oof_rmse"))


def _by(direction: str, score: str = "score"):
    return F.desc(score) if direction == "maximize" else F.asc(score)


def best_experiment(exp: DataFrame, direction: str = "minimize") -> DataFrame:
    return _scored(exp).filter("score IS NOT NULL").orderBy(_by(direction), "experiment_id").limit(1)


def passed_experiments(exp: DataFrame, direction: str = "minimize") -> DataFrame:
    return _scored(exp).filter("gate_result = 'PASS'").orderBy(_by(direction), "experiment_id")


def failed_experiments(exp: DataFrame) -> DataFrame:
    return exp.filter("gate_result = 'FAIL'").orderBy(F.desc("created_at"), "experiment_id")


def list_submissions(sub: DataFrame) -> DataFrame:
    return sub.orderBy(F.desc("created_at"), "submission_id")


def selected_submissions(sub: DataFrame) -> DataFrame:
    return sub.filter("is_final").orderBy(F.desc("public_score"), "submission_id")


def get_experiment(exp: DataFrame, experiment_id: int) -> DataFrame:
    return exp.filter(F.col("experiment_id") == experiment_id)


def top_features(imp: DataFrame, k: int = 10) -> DataFrame:
    return imp.orderBy(F.desc("importance"), "feature").limit(k)


def sql(views: dict[str, DataFrame], text: str, args: dict | None = None) -> DataFrame:
    """A query over ledger views with bound parameters."""
    spark, names = next(iter(views.values())).sparkSession, {}
    for name, df in views.items():
        names[name] = f"{name}_{uuid.uuid4().hex[:8]}"
        df.createOrReplaceTempView(names[name])
    for name, view in names.items():
        text = text.replace("{" + name + "}", view)
    return spark.sql(text, args=args or {})


def ledger_view(sub: DataFrame, exp: DataFrame) -> DataFrame:
    """Submissions with their experiments; `orphan` if there is none."""
    own = exp.select("experiment_id", "branch_name", F.coalesce("oof_score", "oof_rmse").alias("score"))
    return sub.join(own, "experiment_id", "left").withColumn("orphan", F.col("branch_name").isNull())


def ledger_counts(exp: DataFrame, sub: DataFrame) -> DataFrame:
    one = lambda df, name: df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
    return one(exp, "experiments").unionByName(one(sub, "submissions"))


def best_public_score(board: DataFrame, direction: str, skip_zero: bool = True) -> DataFrame:
    """Best numeric score; when minimising, zeros are no scores."""
    s = F.col("public_score").try_cast("double")
    if direction == "maximize":
        return board.agg(F.max(s).alias("best"))
    return board.agg(F.min(F.when(s != 0, s) if skip_zero else s).alias("best"))


def usage_counts(board: DataFrame, day: str) -> DataFrame:
    return board.agg(
        F.count("*").alias("total"),
        F.count_if(F.to_date("created_at") == F.lit(day).cast("date")).alias("today"),
        F.count_if("chosen").alias("chosen"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("chosen"), F.col("filename")))), ",").alias("files"),
    )


def telemetry_rollup(runs: DataFrame) -> DataFrame:
    """kWh and kg CO2 of each job, by power x PUE x seconds and grid intensity."""
    kwh = F.col("tdp_watts") * F.col("pue") * F.col("duration_sec") / 3.6e6
    r = runs.withColumns({"kwh": kwh, "kg": kwh * F.col("g_per_kwh") / 1000})
    return r.groupBy("job").agg(F.count("*").alias("n"), F.sum("duration_sec").alias("seconds"), F.sum("kwh").alias("kwh"), F.sum("kg").alias("kg"), F.count_if(F.col("tdp_watts").isNull()).alias("uninstrumented"))


def flag_counts(flags: DataFrame) -> DataFrame:
    open_ = F.col("cls").isin("ban", "clarify") & ~F.col("resolved")
    return flags.agg(*[F.count_if(F.col("cls") == c).alias(c) for c in ("ban", "clarify", "question")], F.coalesce(F.bool_or(open_), F.lit(False)).alias("must_read"))


def drift_check(scores: DataFrame, direction: str, most: float = 0.05) -> DataFrame:
    """delta = oof - lb where lb > 0, and whether it points at overfitting."""
    delta = F.when(F.col("lb") > 0, F.col("oof") - F.col("lb"))
    over = delta > most if direction == "maximize" else delta < -most
    return scores.withColumns({"delta": delta, "overfit": F.coalesce(over, F.lit(False))})
