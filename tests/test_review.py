"""Review targets, responses and batches."""

import dataclasses
import json

from pyspark.sql import functions as F

from qrelmill import schemas as X
from qrelmill.operators import review as G
from qrelmill.operators import validate as V

DOC = "# Alpha\n\n## One\n\nTarget: t.one\n\n![a](images/a.png)\n\nbody\n\n## Two\n\nmore\n"


def package(spark, targets=True):
    def df(rows, shape):
        return spark.createDataFrame(rows, shape)

    q = [
        ("d", 1, True, "q1", "ask", None, ["alpha", "ghost", "alpha"], "list", False, None, "absent", None, "absent"),
        ("d", 2, True, None, "neg", None, None, "absent", True, None, "absent", None, "absent"),
    ]
    return V.Package(
        datasets=df([("d", "about", True, True, targets, True)], X.DATASETS),
        thresholds=df([], X.THRESHOLDS),
        queries=df(q, X.QUERIES),
        assets=df([("d", 1, True, "t.one.image", "alpha", "images/a.png", "One", "t.one")] if targets else [], X.ASSETS),
        chunks=df([("d", 1, True, None, "alpha", "Nope", "t.one", "t.one.image", None, "absent")] if targets else [], X.CHUNKS),
        corpus=df([("d", "alpha", "alpha.md", DOC)], X.CORPUS),
        asset_files=df([("d", "images/a.png", 1)], X.ASSET_FILES),
    )


def test_targets(spark):
    pkg = package(spark)
    rows = G.review_targets(pkg).orderBy("kind_ord", "pos").collect()
    assert [(r.target_type, r.target_id) for r in rows] == [
        ("dataset", "d"), ("corpus_doc", "alpha"), ("query", "q1"), ("query", "query-2"),
        ("target_asset", "t.one.image"), ("target_chunk", "chunk-1"),
    ]
    payload = [json.loads(r.payload) for r in rows]
    assert payload[0]["dataset_mode"] == "multimodal" and payload[0]["corpus_docs"] == ["alpha"]
    assert payload[0]["query_summary"] == {
        "total": 2, "positive": 1, "negative_expect_none": 1, "missing_expect_any_docs": ["ghost"], "positive_expect_any_docs": ["alpha", "ghost"]
    }
    assert payload[1]["headings"] == ["One", "Two"] and payload[1]["target_markers"] == ["t.one"]
    contexts = payload[2]["expected_doc_contexts"]
    assert [(c["doc"], c["exists"]) for c in contexts] == [("alpha", True), ("ghost", False), ("alpha", True)]
    assert payload[3]["query_role"] == "negative" and payload[3]["expected_doc_contexts"] == []
    assert payload[2]["known_corpus_docs"] == ["alpha"]
    assert payload[4]["section_text"].startswith("## One") and payload[4]["image_refs_in_doc"] == [{"alt": "a", "path": "images/a.png"}]
    assert payload[5]["section_text"] == "" and payload[5]["section_image_refs"] == []
    cut = G.review_targets(pkg, per_part=1).where("kind_ord = 0").orderBy("pos").collect()
    head, rest = json.loads(cut[0].payload), json.loads(cut[1].payload)
    assert head["query_summary"]["positive_expect_any_docs"] == ["alpha"]
    assert head["query_summary"]["positive_expect_any_docs_parts"] == 2 and "corpus_docs_parts" not in head
    assert head["query_summary"]["missing_expect_any_docs"] == ["ghost"]
    assert rest == {"list": "positive_expect_any_docs", "part": 1, "parts": 2, "docs": ["ghost"]}
    assert len(cut) == 2 and cut[1].target_type == "dataset_list"


def test_modes(spark):
    assert G.dataset_mode(package(spark)).first().dataset_mode == "multimodal"
    assert G.dataset_mode(package(spark, False)).first().dataset_mode == "multimodal_without_targets"


def test_groups_and_failures(spark):
    rows = [("d", 1, i, "", "query", f"q{i}", '{"doc":1}') for i in range(10)]
    targets = spark.createDataFrame(rows, "dataset string, kind_ord int, pos bigint, name string, target_type string, target_id string, payload string")
    groups = G.review_groups(targets)
    got = groups.orderBy("grp").collect()
    assert [len(g.targets) for g in got] == [8, 2]
    assert json.loads(got[1].user.split("Targets:\n")[1]) == [
        {"target_type": "query", "target_id": f"q{i}", "doc": 1} for i in (8, 9)
    ]
    results = [
        ("d", "b", got[0].task_id, "succeeded", None, '[{"target_type":"query","target_id":"q0","decision":"PASS","score":1}, {"target_type":"query"}]'),
        ("d", "b", got[1].task_id, "failed", "boom", None),
    ]
    norm = G.normalize_items(spark.createDataFrame(results, "dataset string, batch_id string, task_id string, status string, error string, result string"))
    items = G.fill_failed_items(norm, groups)
    assert items.count() == 10 and items.where("decision = 'fail' and score = 0").count() == 10
    assert {r.reason for r in items.collect()} == {"Invalid review JSON", "boom"}


def test_every_part_of_a_list_is_in_a_task(spark):
    """Names behind the first part reach a prompt, and a query knows its expected documents."""
    pkg = package(spark)
    names = [f"a{i}" for i in range(9)]
    more = spark.createDataFrame([("d", n, f"{n}.md", DOC) for n in names], X.CORPUS)
    pkg = dataclasses.replace(pkg, corpus=pkg.corpus.unionByName(more))
    groups = G.review_groups(G.review_targets(pkg, per_part=2), 3, user="{source}").orderBy("grp").collect()
    rows = [x for g in groups for x in json.loads(g.user)]
    listed = [d for x in rows for d in (x.get("corpus_docs", []) + (x["docs"] if x.get("list") == "corpus_docs" else []))]
    assert listed == sorted(["alpha", *names])
    missing = [d for x in rows if x["target_type"] == "dataset" for d in x["query_summary"]["missing_expect_any_docs"]]
    assert missing == ["ghost"]
    known = {x["target_id"]: x["known_corpus_docs"] for x in rows if x["target_type"] == "query"}
    assert known["q1"] == ["a0", "a1", "alpha"] and known["query-2"] == ["a0", "a1"]


def normalized(spark, *results):
    rows = [("d", "b", f"t{i}", "succeeded", None, r) for i, r in enumerate(results)]
    return G.normalize_items(spark.createDataFrame(rows, "dataset string, batch_id string, task_id string, status string, error string, result string"))


def item(**kw):
    return {"target_type": " query ", "target_id": "q1", "decision": "WARN", "score": 120, "risk_flags": ["ambiguous_query", 3, " "], **kw}


def test_normalize(spark):
    scores = [(120, 100), ("87.9", 87), (-4, 0), (None, 0), ("x", 0), (True, 1), ("nan", 0), (-0.5, 0)]
    results = [json.dumps({"items": [item(score=s)]}) for s, _ in scores]
    rows = G.item_rows(normalized(spark, *results)).orderBy("task_id").collect()
    assert [r.score for r in rows] == [w for _, w in scores]
    first = rows[0]
    assert (first.target_type, first.decision, first.risk_flags) == ("query", "warn", ["ambiguous_query", "3"])
    assert json.loads(first.raw)["score"] == 120
    bad = ['{"x": 1}', "5", json.dumps([item(), item(decision="maybe")]), json.dumps([item(target_id=" ")]), json.dumps([item(), 1]), json.dumps([item(score="inf")])]
    assert [r.void for r in normalized(spark, *bad).collect()] == [True] * 6
    assert not normalized(spark, "[]").first().void


BATCHES = [("d", "b1", "succeeded", None, "2024-01-01", "x"), ("d", "b2", "running", None, "2024-01-02", "x"), ("e", "b3", "failed", "err", "2024-01-01", "x")]


def test_batches(spark):
    batches = spark.createDataFrame(BATCHES, X.REVIEW_BATCHES)
    assert {r.dataset: r.batch_id for r in G.latest_batch(batches).collect()} == {"d": "b2", "e": "b3"}
    assert [r.batch_id for r in G.running_batch(batches).collect()] == ["b2"]
    assert {r.dataset: r.may_start for r in G.batch_may_start(batches).collect()} == {"d": False, "e": True}
    wanted = spark.createDataFrame([("d", "b9"), ("e", "b9"), ("new", "b1"), ("new", "b2")], "dataset string, batch_id string")
    may = {r.dataset: r.may_start for r in G.batch_may_start(batches, wanted).collect()}
    assert may == {"d": False, "e": True, "new": True}
    started = sorted((r.dataset, r.batch_id, r.status) for r in G.start_batches(batches, wanted).collect())
    assert started == [("e", "b9", "running"), ("new", "b1", "running")]
    rows = [("d", "b2", t, i, dec, 1) for t, i, dec in [("query", "q1", "fail"), ("asset", "a", "pass"), ("query", "q0", "fail"), ("x", "y", "odd")]]
    rows.append(("d", "b1", "query", "q9", "fail", 1))
    items = spark.createDataFrame(rows, "dataset string, batch_id string, target_type string, target_id string, decision string, score int")
    assert [r.target_id for r in G.batch_items(items, batches).collect()] == ["q0", "q1", "a", "y"]
    assert [r.target_id for r in G.batch_items(items, batches, "fail").collect()] == ["q0", "q1"]
    assert [r.target_id for r in G.batch_items(items, batches, batch_id="b1").collect()] == ["q9"]
    stats = {r.dataset: (r["pass"], r.warn, r.fail) for r in G.batch_stats(items, batches).collect()}
    assert stats == {"d": (1, 0, 2), "e": (0, 0, 0)}
    targets = spark.createDataFrame([("d", "chunk", "q1"), ("d", "query", "q9"), ("e", "query", "q1")], "dataset string, target_type string, target_id string")
    assert [(r.target_type, r.target_id) for r in G.retry_failed_targets(targets, items, batches).collect()] == [("chunk", "q1")]
