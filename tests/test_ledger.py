"""Commits of the ledgers: writers at once, snapshots, changes, compaction, point reads."""

import threading

import pytest
from pyspark.sql import functions as F

from tessera.operators import ledger as L
from tessera.sources.commits import CommitLog

RUN = "branch_name string, oof_score float, oof_rmse float"


def runs(spark, name, n):
    return spark.createDataFrame([(f"{name}{k:03d}", None if k % 3 == 0 else 0.5, 0.25) for k in range(n)], RUN)


def rows(df):
    return {r.experiment_id: (r.branch_name, r.gate_result) for r in df.collect()}


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "ledger")


def test_writers_at_once_lose_nothing_and_share_no_id(spark, path):
    sizes = [1, 7, 20, 3, 11, 5]
    failed = []

    def write(k):
        try:
            L.log_experiments(runs(spark, f"w{k}-", sizes[k]), path, ["branch_name"])
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    each = [threading.Thread(target=write, args=(k,)) for k in range(len(sizes))]
    [t.start() for t in each]
    [t.join() for t in each]
    assert not failed
    got = L.read_ledger(spark, path, L.EXPERIMENTS)
    ids = [r[0] for r in got.select("experiment_id").collect()]
    assert sorted(ids) == list(range(1, sum(sizes) + 1))
    assert {r[0] for r in got.select("branch_name").collect()} == {f"w{k}-{i:03d}" for k, n in enumerate(sizes) for i in range(n)}
    assert got.filter("metric = 'rmse' AND oof_score = 0.25").count() == sum(-(-n // 3) for n in sizes)


def test_changes_at_once_both_hold(spark, path, monkeypatch):
    L.log_experiments(runs(spark, "a", 30), path, ["branch_name"])
    change = lambda k, field, value: spark.createDataFrame([(k, value)], f"experiment_id long, {field} string")
    plain, meanwhile = CommitLog.put, [True]

    def put(self, n, entry):
        if entry["kind"] == "update" and meanwhile:  # another writer is quicker
            meanwhile.clear()
            L.update_ledger(spark, path, L.EXPERIMENTS, change(4, "notes", "first"))
            L.log_experiments(runs(spark, "b", 2), path, ["branch_name"])
        return plain(self, n, entry)

    monkeypatch.setattr(CommitLog, "put", put)
    L.update_ledger(spark, path, L.EXPERIMENTS, change(4, "gate_result", "PASS"))
    got = L.read_ledger(spark, path, L.EXPERIMENTS)
    assert got.count() == 32
    one = got.filter("experiment_id = 4").first()
    assert (one.gate_result, one.notes, one.branch_name) == ("PASS", "first", "a003")
    assert L.read_ledger(spark, path, L.EXPERIMENTS, 1).filter("notes IS NOT NULL OR gate_result IS NOT NULL").count() == 0


def test_compaction_keeps_state_and_snapshots(spark, path, monkeypatch):
    L.log_experiments(runs(spark, "a", 40), path, ["branch_name"])
    set_gate = lambda where, to: L.update_ledger(spark, path, L.EXPERIMENTS, L.read_ledger(spark, path, L.EXPERIMENTS).filter(where).select("experiment_id", F.lit(to).alias("gate_result")))
    set_gate("experiment_id % 5 = 0", "FAIL")
    before = L.read_ledger(spark, path, L.EXPERIMENTS)
    was, plain, meanwhile = rows(before), CommitLog.put, [True]

    def put(self, n, entry):
        if entry["kind"] == "compact" and meanwhile:
            meanwhile.clear()
            set_gate("experiment_id = 10", "PASS")
            L.log_experiments(runs(spark, "z", 1), path, ["branch_name"])
        return plain(self, n, entry)

    monkeypatch.setattr(CommitLog, "put", put)
    L.compact_ledger(spark, path, L.EXPERIMENTS)
    now = rows(L.read_ledger(spark, path, L.EXPERIMENTS))
    assert now == was | {10: ("a009", "PASS"), 41: ("z000", None)}
    assert rows(before) == was == rows(L.read_ledger(spark, path, L.EXPERIMENTS, 2))
    L.log_experiments(runs(spark, "y", 1), path, ["branch_name"])
    assert rows(L.read_one(spark, path, L.EXPERIMENTS, 42)) == {42: ("y000", None)}
    assert [n for n, _ in CommitLog(spark, path).entries()] == [5, 3, 4, 6]


def test_a_point_read_opens_one_file(spark, path):
    for name in "abcd":
        L.log_experiments(runs(spark, name, 50), path, ["branch_name"])
    one = L.read_one(spark, path, L.EXPERIMENTS, 120)
    assert rows(one) == {120: ("c019", None)}
    assert len(one.inputFiles()) == 1 and "EqualTo(_k,20)" in one._jdf.queryExecution().toString()
    assert L.read_one(spark, path, L.EXPERIMENTS, 999).count() == 0
    assert L.read_one(spark, path + "-none", L.EXPERIMENTS, 1).count() == 0
    assert L.read_ledger(spark, path + "-none", L.EXPERIMENTS).count() == 0
    L.compact_ledger(spark, path, L.EXPERIMENTS)
    assert len(L.read_one(spark, path, L.EXPERIMENTS, 120).inputFiles()) == 1
    assert not CommitLog(spark, path).put(5, {"kind": "append"})


def test_no_rows_and_nulls(spark, path):
    L.log_submissions(spark.createDataFrame([], "filename string"), path, ["filename"])
    L.log_submissions(spark.createDataFrame([(None,), (None,)], "filename string"), path, ["filename"])
    assert sorted(r[0] for r in L.read_ledger(spark, path, L.SUBMISSIONS).select("submission_id").collect()) == [1, 2]


def test_numbers_do_not_hang_on_how_partitions_are_coalesced(spark):
    """Sizes and rows are shuffled with rows of different width: read twice, they
    were coalesced apart, and rows were lost or shared numbers."""
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        wide = spark.range(0, 60000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
        got = L.numbered(wide, "k", ["id"]).agg(F.count("text"), F.count_if(F.col("k") != F.col("id") + 1), F.max(F.length("text"))).first()
        assert tuple(got) == (60000, 0, 128)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
