"""Guarded appends: one of two writers wins, and nothing of the other is seen."""

import pytest
from pyspark.sql import functions as F

from qrelmill import schemas as X
from qrelmill.sources import changes as C


def wanted(spark, *rows):
    return spark.createDataFrame(list(rows), "dataset string, batch_id string, created_at string")


def state(table):
    return {(r.dataset, r.batch_id): (r.status, r.error, r.created_at, r.updated_at) for r in C.current_batches(table.read()).collect()}


def test_one_batch_runs_per_dataset(spark, tmp_path):
    table = C.batches_table(spark, str(tmp_path / "b"))
    assert state(table) == {} and table.version() == 0
    started = C.start_batches(table, wanted(spark, ("a", "a1", "t1"), ("b", "b1", "t1"), ("a", "a2", "t1")))
    assert {(r.dataset, r.batch_id, r.status) for r in started.collect()} == {("a", "a1", "running"), ("b", "b1", "running")}
    assert C.start_batches(table, wanted(spark, ("a", "a3", "t2"), ("c", "c1", "t2"))).collect()[0].dataset == "c"
    closed = spark.createDataFrame([("a", "a1", "succeeded", None, "t3"), ("b", "b1", "failed", "boom", "t3"), ("z", "z1", "failed", "", "t3"), ("c", "c1", "odd", None, "t3")], "dataset string, batch_id string, status string, error string, updated_at string")
    C.close_batches(table, closed)
    want = {("a", "a1"): ("succeeded", None, "t1", "t3"), ("b", "b1"): ("failed", "boom", "t1", "t3"), ("c", "c1"): ("running", None, "t2", "t2")}
    assert state(table) == want
    table.compact(C.newest_batches)
    assert state(table) == want and table.read().count() == 3
    C.start_batches(table, wanted(spark, ("a", "a4", "t4")))
    assert state(table)["a", "a4"][0] == "running" and len(state(table)) == 4


def test_of_two_starts_at_once_one_wins(spark, tmp_path, monkeypatch):
    first, second = (C.batches_table(spark, str(tmp_path / "b")) for _ in range(2))
    commit = second._commit

    def late(*args):
        C.start_batches(first, wanted(spark, ("a", "won", "t1")))
        return commit(*args)

    monkeypatch.setattr(second, "_commit", late)
    with pytest.raises(C.Conflict):
        C.start_batches(second, wanted(spark, ("a", "lost", "t1")))
    assert list(state(first)) == [("a", "won")]
    # The exclusive commit file alone refuses as well.
    stale = C.batches_table(spark, str(tmp_path / "b"))
    monkeypatch.setattr(stale, "version", lambda: 0)
    with pytest.raises(C.Conflict):
        stale.append(first.read().drop("seq"), 0)
    assert first.version() == 1 and first.add(first.read().drop("seq")) == 2


def test_decisions_are_checked_before_they_are_saved(spark, tmp_path):
    table = C.ChangeTable(spark, str(tmp_path / "d"), X.DECISIONS)

    def rows(*given):
        return spark.createDataFrame([("a", c, d, "", labels, "", at) for c, d, labels, at in given], X.DECISIONS)

    corpus = spark.createDataFrame([("a", "doc")], "dataset string, stem string")
    for bad, why in ((("x", "maybe", [], "t"), "invalid decision: maybe"), (("x", None, [], "t"), "None"), (("x", "approve", ["gone"], "t"), "unknown document: gone")):
        with pytest.raises(C.Refused, match=why):
            C.save_decisions(table, rows(("y", "approve", [], "t"), bad), corpus)
    assert table.version() == 0
    C.save_decisions(table, rows(("x", "approve", ["doc"], "t1"), ("y", "reject", [], "t1")), corpus)
    C.save_decisions(table, rows(("x", "rewrite", [], "t1")))
    assert {r.candidate_id: r.decision for r in C.saved_decisions(table).collect()} == {"x": "rewrite", "y": "reject"}
