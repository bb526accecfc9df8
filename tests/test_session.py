"""The partitions of exchanges follow the size of the input."""

from qrelmill import session
from qrelmill.plans.suite import QUERIES

SMALL = "/root/testdata/sf0.001"


def _tasks(spark, query: str) -> int:
    """Partitions behind the first exchange of a query that groups by order."""
    plan = QUERIES[query](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    return int(plan.split("hashpartitioning(o_orderkey#")[1].split(", ")[1].split(")")[0])


def test_partitions_grow_with_the_input(spark, monkeypatch):
    rows = {q: QUERIES[q](spark, SMALL).count() for q in ("leak_sample", "explode_report")}
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _tasks(spark, "leak_sample") == asked
    assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) == session.TASK_BYTES
    monkeypatch.setattr(session, "INPUT_BYTES", 4096)
    for query, n in rows.items():
        assert _tasks(spark, query) > 4 * asked
        assert QUERIES[query](spark, SMALL).count() == n
    monkeypatch.undo()
    assert _tasks(spark, "explode_report") == asked
