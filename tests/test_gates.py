"""Gates, roll-ups, ablations and the baseline log."""

import pytest
from pyspark.sql import functions as F

from qrelmill.functions.keys import apply_overrides, variant_label
from qrelmill.operators import gates as J


@pytest.mark.parametrize("codes, worst", [([0, 0], 0), ([0, 1], 1), ([1, 2], 2), ([0, 2, 1], 2), ([0, 3], 1), ([], 0)])
def test_worst_exit_code(spark, codes, worst):
    df = spark.createDataFrame([(c, True) for c in codes], "exit_code int, passed boolean")
    row = J.summarize_runs(df.drop("passed")).first()
    assert (row.worst_exit_code, row.n_total, row.n_passed, row.passed) == (worst, len(codes), codes.count(0), worst == 0)


def test_labels_and_overrides(spark):
    df = spark.createDataFrame([({},), ({"rrf_k": "60"},), ({"b": "2", "a": "1"},)], "ov map<string,string>")
    assert [r[0] for r in df.select(variant_label(F.col("ov"))).collect()] == ["baseline", "rrf_k=60", "a=1,b=2"]
    base = F.create_map(F.lit("a"), F.lit("0"), F.lit("z"), F.lit("9"))
    assert [r[0] for r in df.select(apply_overrides(base, F.col("ov"))).collect()][2] == {"z": "9", "a": "1", "b": "2"}
    grid = J.variant_grid(spark.createDataFrame([("d",)], "dataset string"), [{}, {"k": "1"}], {"k": "0"})
    assert [(r.label, r.settings) for r in grid.orderBy("ord").collect()] == [("baseline", {"k": "0"}), ("k=1", {"k": "1"})]
    with pytest.raises(ValueError):
        J.variant_grid(grid, ["x"], {})


def test_ablation_table(spark):
    df = spark.createDataFrame([("baseline", 0, {"mrr": 0.5, "hit_at_3": 1.0})], "label string, exit_code int, metrics map<string,double>")
    line = J.ablation_lines(J.ablation_table(df)).first().line
    assert line == "| baseline | 0 | 1.000 | - | 0.500 | - | - |"


def test_gate_and_baseline(spark):
    metrics = spark.createDataFrame([("r", "d", 0.8, 0.9, 0.5, 0.6, 1.0), ("s", "e", 1.0, 1.0, 1.0, 1.0, 1.0)],
                                    "run_id string, dataset string, hit_at_3 double, hit_at_10 double, mrr double, ndcg_at_10 double, recall_at_100 double")
    limits = spark.createDataFrame([("d", "hit_at_3", 0.8), ("d", "mrr", 0.6), ("d", "new_metric", 0.1)], "dataset string, key string, value double")
    gate = J.threshold_gate(metrics, limits)
    assert {r.metric: r.ok for r in gate.collect()} == {"hit_at_3": True, "mrr": False, "new_metric": False}
    assert {r.run_id: r.exit_code for r in J.gate_verdict(gate, metrics).collect()} == {"r": 1, "s": 0}
    now = spark.createDataFrame([("d", "m", "mrr", 0.47), ("d", "m", "latency", 12.0), ("d", "m", "hit_at_3", 0.79)], "dataset string, mode string, metric string, value double")
    was = spark.createDataFrame([("d", "m", "mrr", 0.5), ("d", "m", "latency", 10.0), ("d", "m", "hit_at_3", 0.8)], now.schema)
    got = {r.metric: r.regressed for r in J.baseline_regression(now, was, lower_is_better=["latency"]).collect()}
    assert got == {"mrr": True, "latency": True, "hit_at_3": False}
    cal = {r.metric: r.threshold for r in J.calibrate_thresholds(J.long_metrics(metrics, ["run_id"]).where("run_id = 's'")).collect()}
    assert cal == {"hit_at_3": 0.95, "hit_at_10": 0.95, "mrr": 0.95, "ndcg_at_10": 0.97, "recall_at_100": 0.97}


def test_baseline_log(spark):
    added = [
        ("good", "## 2026-06-25 — entry"), ("good", "nDCG@10 0.9"),
        ("reused", "## 0.1.0 — old "), ("reused", "mrr 0.5"),
        ("sub", "### 2026-06-25"), ("sub", "recall_at_100"),
        ("prose", "## 2026-06-25"), ("prose", "recall that this"),
        ("other", "nothing"),
    ]
    touched = ["good", "reused", "sub", "prose", "none"]
    got = J.baseline_log_check(
        spark.createDataFrame(added, "change_id string, text string"),
        spark.createDataFrame([("reused", "## 0.1.0 — old")], "change_id string, header string"),
        spark.createDataFrame([(c, "datasets/x") for c in touched] + [("other", "src/x")], "change_id string, path string"),
    )
    head, metric = "no new dated or versioned entry header", "entry names no retrieval metric"
    assert sorted((r.change_id, r.violation) for r in got.collect()) == sorted(
        [("reused", head), ("sub", head), ("prose", metric), ("none", head), ("none", metric)]
    )
