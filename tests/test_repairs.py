"""Answers that were once wrong, and flows that once did not close."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from qrelmill.functions import keys as K
from qrelmill.functions import text as T
from qrelmill.operators import curation, gates, review
from qrelmill.sources import readers as R
from qrelmill.sources import sinks


@pytest.mark.parametrize("evidence", [["a", "b"], {"z": 1, "a": ["é", {"k": None}]}, "plain \x0b\x1f text", 'quote " \\ /', 3])
def test_candidate_id_of_any_evidence(spark, evidence):
    raw = json.dumps({"q": "x", "evidence": evidence})
    df = spark.createDataFrame([(raw,)], "raw string").select(F.parse_json("raw").alias("raw"))
    got = df.select(K.candidate_id(F.col("raw"), F.lit("x \x0b"), F.array(F.lit("d")))).first()[0]
    text = json.dumps({"q": "x \x0b", "expect_any": ["d"], "evidence": evidence}, ensure_ascii=False, sort_keys=True)
    assert got == hashlib.sha1(text.encode()).hexdigest()[:12]


def test_paths_are_resolved(spark):
    paths = ["a/../b.png", "../img/a.png", "./a//b/./c.png", "a/b/../../c.png", "a/../../c.png", "x..y/z", "plain.png"]
    want = ["b.png", "../img/a.png", "a/b/c.png", "c.png", "../c.png", "x..y/z", "plain.png"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(T.normalize_path(F.col("p"))).collect()] == want


def test_scores_as_text(spark):
    values = ['"1d"', '"0x1p3"', '" 7.9 "', '"1e2"', '"-3"', '"1_0"', "55.5", "true", '"inf"', '".5"', '"5."', '"x"']
    df = spark.createDataFrame([(v,) for v in values], "v string").select(F.parse_json("v").alias("v"))
    got = [r[0] for r in df.select(review._clamped_score(F.col("v"))).collect()]
    assert got == [0, 0, 7, 100, 0, 10, 55, 1, 100, 0, 5, 0]


def test_a_header_with_a_tab_is_known(spark):
    added = spark.createDataFrame([("c", "## 2024-01-02 run\t"), ("c", "mrr 0.5")], "change_id string, text string")
    headers = spark.createDataFrame([("c", "## 2024-01-02 run")], "change_id string, header string")
    changed = spark.createDataFrame([("c", gates.DATASET_PREFIX + "x/a.md")], "change_id string, path string")
    out = [r.violation for r in gates.baseline_log_check(added, headers, changed).collect()]
    assert "no new dated or versioned entry header" in out


def test_equal_times_keep_one_decision(spark):
    schema = "dataset string, candidate_id string, decision string, edited_q string, edited_expect_any array<string>, notes string, updated_at string, seq int"
    rows = [("d", "c", "accept", "q", None, "n", "t1", 1), ("d", "c", "reject", "q", None, "n", "t1", 2)]
    for order in (rows, rows[::-1]):
        assert curation.upsert_decisions(spark.createDataFrame(order, schema)).first().decision == "reject"


QUERY = "dataset string, pos int, id string, q string, expect_any array<string>"


def test_a_blocked_dataset_keeps_its_export(spark, tmp_path):
    path = str(tmp_path / "q")
    queries = spark.createDataFrame([("a", 1, "1", "x", ["d"]), ("b", 1, "1", "y", ["d"])], QUERY)
    none = spark.createDataFrame([], "dataset string, message string")
    sinks.write_queries(queries, none, path)
    blocked = spark.createDataFrame([("a", "bad"), ("idle", "nothing to export")], "dataset string, message string")
    sinks.write_queries(queries.withColumn("q", F.lit("new")), blocked, path, strict=False)
    got = {r.dataset: r.q for r in spark.read.json(path).collect()}
    assert got == {"a": "x", "b": "new"}
    with pytest.raises(sinks.ExportBlocked, match="bad"):
        sinks.write_queries(queries, blocked, path)
    idle = blocked.where("dataset = 'idle'")
    sinks.write_queries(queries.where("dataset = 'b'"), idle, path)
    sinks.write_corpus(spark.createDataFrame([("a", "s", "t")], "dataset string, stem string, text string"), str(tmp_path / "c"))
    sinks.write_corpus(spark.createDataFrame([("b", "s", "t")], "dataset string, stem string, text string"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2


def test_the_log_is_read_back_as_candidates(spark, tmp_path):
    log, root = str(tmp_path / "log"), tmp_path / "root"
    (root / "d").mkdir(parents=True)
    (root / "other").mkdir()
    (root / "other" / "candidates.jsonl").write_text('{"q": "direct"}\n')
    schema = "task_id string, dataset string, stage string, status string, attempts int, result string, raw_response string, error string, skipped boolean"
    result = json.dumps([{"q": "one", "expect_any": ["x"]}, {"q": "two"}])
    rows = [
        ("t1", "d", "generate_candidates", "succeeded", 1, result, result, None, False),
        ("t2", "d", "generate_candidates", "failed", 4, None, None, "boom", False),
        ("t3", "d", "generate_candidates", "succeeded", 1, result, result, None, True),
        ("t4", "other", "generate_candidates", "succeeded", 1, '[{"q": "late"}]', "", None, False),
    ]
    results = spark.createDataFrame(rows, schema)
    sinks.append_task_starts(results, log)
    sinks.append_task_log(results, log)
    events = R.read_audit_log(spark, log).collect()
    assert {(e.task_id, e.kind) for e in events} == {(t, k) for t in ("t1", "t2", "t4") for k in ("start", "finish")}
    assert json.loads(next(e.result for e in events if e.task_id == "t1" and e.kind == "finish")) == json.loads(result)
    found = curation.extract_candidates(R.scan_candidates(spark, str(root), log))
    got = curation.normalize_candidates(found).collect()
    assert sorted((r.dataset, r.q) for r in got) == [("d", "one"), ("d", "two"), ("other", "direct")]


def test_a_root_below_a_folder_named_corpus(spark, tmp_path):
    base = tmp_path / "corpus" / "sets"
    (base / "d" / "corpus" / "img").mkdir(parents=True)
    (base / "d" / "dataset.yaml").write_text("name: d\n")
    (base / "d" / "queries.yaml").write_text("queries:\n  - q: ask\n    expect_any: [a]\n")
    (base / "d" / "corpus" / "a.md").write_text("# A\n")
    (base / "d" / "corpus" / "img" / "x.png").write_bytes(b"x")
    for root in (str(base), f"file://{base}/"):
        pkg = R.load_packages(spark, root)
        assert pkg.queries.count() == 1
        assert {r.path for r in pkg.asset_files.collect()} == {"a.md", "img/x.png"}
