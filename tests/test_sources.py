"""Files in, tables out, and back."""

import json

import pytest

from qrelmill.operators import quality
from qrelmill.operators import validate as V
from qrelmill.sources import readers as R
from qrelmill.sources import sinks


@pytest.fixture
def root(tmp_path):
    base = tmp_path / "da ta+x"
    good = base / "good"
    (good / "corpus" / "images").mkdir(parents=True)
    (good / "corpus" / "nested").mkdir()
    (good / "corpus" / "doc.md").write_text("# Doc\n\n## Fruit\n\nTarget: f.a\n\n![a](./images/a.png)\n", encoding="utf-8")
    (good / "corpus" / "bad bytes.md").write_bytes(b"caf\xff")
    (good / "corpus" / "nested" / "page.HTML").write_text("<p>x</p>")
    (good / "corpus" / "images" / "a.png").write_bytes(b"123")
    (good / "dataset.yaml").write_text("name: good\ndescription: about\nthresholds: {mrr: 0.5, hit_at_3: 1, odd: true, bad: x}\n")
    (good / "queries.yaml").write_text(
        "queries:\n- {id: q1, q: what, expect_any: [doc]}\n- {id: q2, q: b, expect_none: true, expect_asset_any: []}\n- text\n- {id: 5, q: z, expect_any: doc}\n"
    )
    (good / "targets.yaml").write_text(
        "assets:\n- {id: f.a.image, doc: doc, path: images/a.png, heading: Fruit, anchor: f.a}\n"
        "chunks:\n- {id: c, doc: doc, heading: Fruit, anchor: f.a, asset_ids: [f.a.image, 3]}\n"
    )
    broken = base / "broken"
    broken.mkdir()
    (broken / "queries.yaml").write_text("- not a mapping\n")
    return str(base)


def test_packages(spark, root):
    pkg = R.load_packages(spark, root)
    flags = {r.dataset: (r.has_meta, r.has_queries, r.has_targets, r.has_corpus) for r in pkg.datasets.collect()}
    assert flags == {"good": (True, True, True, True), "broken": (False, True, False, False)}
    assert {r.key: (r.value, r.numeric) for r in pkg.thresholds.collect()} == {
        "mrr": (0.5, True), "hit_at_3": (1.0, True), "odd": (1.0, True), "bad": (None, False)
    }
    got = {}
    for r in V.validate_packages(pkg).orderBy("section", "pos", "sub").collect():
        got.setdefault(r.dataset, []).append(r.message)
    assert got["broken"] == ["missing dataset.yaml", "missing corpus/"]
    assert sorted(got["good"]) == sorted(
        [
            "chunk target #1 asset_ids contains empty id",
            "unknown threshold key: odd",
            "unknown threshold key: bad",
            "threshold bad must be numeric",
            "query #2 expect_asset_any must be a non-empty list",
            "query #3 must be a mapping",
            "query #4 has empty id",
            "query #4 expect_any must be a list",
        ]
    )


def test_corpus(spark, root):
    docs = {r.stem: r.text for r in R.scan_corpus(spark, root).collect()}
    assert set(docs) == {"doc", "bad bytes"} and docs["bad bytes"] == "caf�"
    assert R.scan_corpus(spark, root, recursive=True).where("rel_path = 'nested/page.HTML'").count() == 1
    files = R.list_files(spark, root)
    assert [r.dataset for r in R.discover_datasets(files).collect()] == ["good"]
    assert R.discover_datasets(files, ["x/broken"]).count() == 0


def test_report_stream(spark, tmp_path):
    lines = [
        {"event": "progress"},
        {"metrics": {"mrr": 0.1}, "per_query": [{"id": "a", "ranked": ["x"], "expect_any": ["x"]}]},
        {"metrics": {"mrr": 0.2}, "per_query": [{"id": "a"}, {"id": "b", "scores": [0.5]}], "negative_diagnostics": [{"q": "n", "ranked": ["z"]}]},
        {"metrics": {"mrr": 0.3}, "passed": True},
        {"passed": False},
    ]
    (tmp_path / "run1.ndjson").write_text("\n".join(["", "not json", *map(json.dumps, lines)]) + "\n")
    (tmp_path / "run2.ndjson").write_text('{"event": "x"}\nnot json\n')
    got = R.scan_eval_stream(spark, str(tmp_path))
    assert got.where("run_id = 'run1'").count() == 5
    pick = {rule: R.report_metrics(R.select_report(got, rule)).collect() for rule in ("last", "longest", "longest_metrics")}
    assert {k: [(r.run_id, r.value) for r in v] for k, v in pick.items()} == {
        "last": [("run1", 0.3)], "longest": [("run1", 0.2)], "longest_metrics": [("run1", 0.2)]
    }
    report = R.select_report(got, "longest")
    rows = R.explode_report(report).orderBy("pos").collect()
    assert [(r.id, r.ranked) for r in rows] == [("a", []), ("b", [])]
    assert R.explode_report(report, "negative_diagnostics").first().ranked == ["z"]
    with pytest.raises(ValueError):
        R.select_report(got, "best")


def test_candidate_sources(spark, tmp_path):
    for name, files in {"a": ["candidates", "a"], "b": ["b", "other"]}.items():
        (tmp_path / name).mkdir()
        for f in files:
            (tmp_path / name / f"{f}.jsonl").write_text(json.dumps({"q": f}) + "\n\nbad\n")
    got = R.scan_candidates(spark, str(tmp_path)).collect()
    assert sorted((r.dataset, r.source) for r in got) == [("a", "direct"), ("b", "audit")]


def test_sinks(spark, tmp_path, root):
    pkg = R.load_packages(spark, root)
    sinks.write_targets(pkg.assets, pkg.chunks, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t/chunks")).first().asset_ids == ["f.a.image", None]
    sinks.write_corpus(pkg.corpus, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2
    flagged = quality.quality_reasons(pkg.corpus)
    clean = sinks.quarantine(flagged, str(tmp_path / "q"), "20240101")
    assert clean.count() == 0 and not (tmp_path / "q").exists()
    sinks.quarantine(flagged, str(tmp_path / "q"), "20240101", apply=True)
    assert spark.read.parquet(str(tmp_path / "q")).where("run_ts = '20240101' or run_ts = 20240101").count() == 2
    rows = spark.createDataFrame([("baseline", 0, {"mrr": 0.5})], "label string, exit_code int, metrics map<string,double>")
    sinks.write_ablation(rows, str(tmp_path / "a"))
    assert spark.read.text(str(tmp_path / "a/table")).first()[0].startswith("| baseline | 0 |")
    sinks.write_summary(rows.drop("metrics"), str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).count() == 1
