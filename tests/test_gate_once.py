"""A gate computes its metrics once."""

from qrelmill.operators import gates, scoring


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_gate_computes_its_metrics_once(spark):
    rows = [("r", "d", "zh-1", ["a"], ["a"]), ("r", "d", "2", ["b"], ["a"]), ("s", "e", "3", ["x"], ["x"])]
    per_query = spark.createDataFrame(rows, "run_id string, dataset string, id string, ranked array<string>, expect_any array<string>")
    limits = spark.createDataFrame([("d", "mrr", 0.5), ("d", "hit_at_3", 0.6), ("d", "latency", 0.1), ("f", "mrr", 0.1)], "dataset string, key string, value double")
    gate = gates.threshold_gate(scoring.aggregate_metrics(per_query, ["run_id", "dataset"]), limits)
    assert _plan(gate).count("Aggregate") == 1
    want = {("r", "mrr", 0.5, 0.5, True), ("r", "hit_at_3", 0.5, 0.6, False), ("r", "latency", None, 0.1, False)}
    assert {(r.run_id, r.metric, r.value, r.threshold, r.ok) for r in gate.collect()} == want
