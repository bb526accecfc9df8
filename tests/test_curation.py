"""Candidates, decisions, exports, generated query sets and corpora."""

import json

import pytest
from pyspark.sql import functions as F

from qrelmill import schemas as X
from qrelmill.operators import catalog, curation, ordering, quality
from qrelmill.sources import readers, sinks

LINES = "dataset string, source string, line_no int, value string"


def load(spark, rows):
    return curation.load_candidates(readers.parse_lines(spark.createDataFrame(rows, LINES)))


def decisions(spark, rows):
    return curation.upsert_decisions(spark.createDataFrame(rows, X.DECISIONS))


def corpus(spark, *stems):
    return spark.createDataFrame([("d", s, s + ".md", "# x") for s in stems], X.CORPUS)


def test_audit_lines_yield_candidates(spark):
    done = {"stage": "generate_candidates", "status": "succeeded", "result": [{"id": "cand-1", "q": "What?", "expect_any": ["doc1"]}, 5]}
    rows = [
        ("d", "audit", 1, json.dumps(done)),
        ("d", "audit", 2, json.dumps({**done, "status": "failed"})),
        ("d", "audit", 3, json.dumps({**done, "stage": "other"})),
        ("d", "audit", 4, json.dumps({"q": "not direct"})),
        ("d", "audit", 5, json.dumps({**done, "result": {"corrected_q": "single"}})),
        ("d", "audit", 6, "not json"),
        ("d", "audit", 7, json.dumps(done)),
    ]
    got = load(spark, rows).orderBy("pos").collect()
    assert [(r.candidate_id, r.q, r.expect_any) for r in got][0] == ("cand-1", "What?", ["doc1"])
    assert [r.q for r in got] == ["What?", "single"]


def test_direct_lines(spark):
    rows = [
        ("d", "direct", 1, json.dumps({"q": " ", "corrected_q": " fixed "})),
        ("d", "direct", 2, json.dumps({"q": "", "corrected_q": " fixed ", "corrected_expect_any": "[a, b]"})),
        ("d", "direct", 3, json.dumps({"q": None})),
        ("d", "direct", 4, json.dumps([{"q": "x", "expect_any": [1, " "]}, "skip"])),
    ]
    got = load(spark, rows).orderBy("pos").collect()
    assert [(r.q, r.expect_any) for r in got] == [("fixed", ["a", "b"]), ("x", ["1"])]


CANDS = [
    ("d", "direct", 1, json.dumps({"id": "a", "q": "qa", "expect_any": ["doc"], "query_type": "asset", "expect_asset_any": ["i"]})),
    ("d", "direct", 2, json.dumps({"id": "b", "q": "qb", "expect_any": ["doc"], "evidence": "e", "confidence": 0.5})),
    ("d", "direct", 3, json.dumps({"id": "c", "q": "qc", "expect_none": True})),
    ("d", "direct", 4, json.dumps({"id": "e", "q": "qe"})),
]


def test_export(spark, tmp_path):
    cands = load(spark, CANDS)
    dec = decisions(
        spark,
        [
            ("d", "a", "reject", "", [], "", "t0"),
            ("d", "a", "approve", "", [], "", "t1"),
            ("d", "b", "rewrite", " new text ", ["doc2"], "n", "t2"),
            ("d", "c", "approve", "", [], "", "t3"),
            ("d", "e", "reject", "", [], "", "t4"),
        ],
    )
    out = curation.export_queries(cands, dec).orderBy("updated_at").collect()
    assert [(r.id, r.q, r.expect_any, r.expect_none) for r in out] == [
        ("a", "qa", ["doc"], None), ("b", "new text", ["doc2"], None), ("c", "qc", None, True)
    ]
    assert out[0].query_type == "asset" and out[0].expect_asset_any == ["i"]
    queries = curation.export_queries(cands, dec)
    violations = curation.export_violations(cands, dec, corpus(spark, "doc", "doc2"))
    assert violations.count() == 0
    path = str(tmp_path / "out")
    sinks.write_queries(queries, violations, path)
    written = spark.read.json(path).orderBy("updated_at").collect()
    assert [r.id for r in written] == ["a", "b", "c"] and written[0].dataset == "d"
    bad = curation.export_violations(cands, dec, corpus(spark, "doc"))
    assert [r.message for r in bad.collect()] == ["b: expect_any references missing stem: doc2"]
    with pytest.raises(sinks.ExportBlocked):
        sinks.write_queries(queries.limit(1), bad, path)
    assert spark.read.json(path).count() == 3
    queue = {r.candidate_id: r for r in curation.review_queue(cands, dec, spark.createDataFrame(
        [("d", "t1", "generate_candidates", "failed", 2, "boom", "u", 1), ("d", "t2", "generate_candidates", "succeeded", 1, None, "u", 2)],
        "dataset string, task_id string, stage string, status string, attempts int, last_error string, updated_at string, rank int",
    )).collect()}
    assert queue["b"].edited_q == " new text " and queue["b"].expected == ["doc2"] and queue["b"].confidence == "0.5"
    assert queue["b"].audit == "succeeded · attempts 1 · " and queue["b"].evidence == "e"


def test_blocked_exports(spark):
    cands = load(spark, CANDS)
    dec = decisions(spark, [("d", "zz", "approve", "", [], "", "t"), ("d", "e", "approve", "", [], "", "t")])
    got = sorted(r.message for r in curation.export_violations(cands, dec, corpus(spark, "doc")).collect())
    assert got == ["e: must set expect_any or expect_none", "no approved or rewritten candidates to export", "reviewed candidate not found: zz"]


def spread_python(items, count):
    if count <= 0 or not items:
        return []
    if count >= len(items):
        return items
    return [items[int(i * (len(items) / count))] for i in range(count)]


def test_even_spread_plain_and_ranged(spark):
    sizes = {"a": 1, "b": 7, "c": 1000}
    df = spark.createDataFrame([(k, f"{i:05d}") for k, n in sizes.items() for i in range(n)], "k string, v string").repartition(5)
    for count in (-1, 0, 1, 3, 7, 100, 333, 999, 1000, 2000):
        want = {k: spread_python([f"{i:05d}" for i in range(n)], count) for k, n in sizes.items()}
        rows = ordering.even_spread(df, count, ["k"], ["v"], safe_rows=10**9 if count % 3 else 100).collect()
        got = {k: sorted(r.v for r in rows if r.k == k) for k in sizes}
        assert got == want, count


def test_dense_index_over_ranges(spark):
    rows = [(None if i % 5 == 0 else f"k{i % 3}", None if i == 17 else i * 37 % 4001, i) for i in range(4001)]
    df = spark.createDataFrame(rows, "k string, o int, i int").repartition(6)
    plain = {r.i: (r.idx, r.n) for r in ordering.dense_index(df, ["k"], ["o", "i"], "idx", "n").collect()}
    ranged = {r.i: (r.idx, r.n) for r in ordering.dense_index(df, ["k"], ["o", "i"], "idx", "n", safe_rows=50).collect()}
    assert plain == ranged and len(plain) == 4001
    groups = ordering.chunk_rows(df, 8, ["k"], ["o", "i"], safe_rows=50).groupBy("k", "grp").count()
    assert groups.agg(F.max("count")).first()[0] == 8


def test_ranges_are_bounded(spark, monkeypatch):
    """Borders lie on the driver and in the plan: their number must not grow with the rows."""
    seen, found = [], ordering._borders

    def keep(*args):
        seen.append(found(*args))
        return seen[-1]

    monkeypatch.setattr(ordering, "_borders", keep)
    df = spark.range(4000).selectExpr("id % 3 as k", "id * 37 % 4001 as o").repartition(3)
    got = {(r.k, r.o): r.idx for r in ordering.dense_index(df, ["k"], ["o"], safe_rows=2).collect()}
    assert got == {(r.k, r.o): r.idx for r in ordering.dense_index(df, ["k"], ["o"]).collect()}
    assert len(seen) == 1 and len(seen[0]) < 256


def test_marker_queries_and_negatives(spark):
    docs = [("d", f"zh-{i}", f"zh-{i}.md", "") for i in range(3)] + [("d", f"en-{i}", f"en-{i}.md", "") for i in range(30)] + [("d", "x", "x.md", "")]
    q = curation.marker_queries(spark.createDataFrame(docs, X.CORPUS), 10)
    langs = [r.lang for r in q.collect()]
    assert langs.count("zh") == 3 and langs.count("en") == 7
    assert "哪个文档包含检索标记 docmarkzh0？" in [r.q for r in q.collect()]
    both = curation.append_negatives(q, ["n1", "n2", "n3"], 2)
    assert both.count() == 12 and both.where("expect_none").count() == 2


ITEM = [
    ("d", "fruits", "水果", "intro", "fruits", 1, "apple", "苹果", "Apple", "d1", "v1", "u1", "aq", "cq"),
    ("d", "fruits", "水果", "intro", "fruits", 2, "pear", "梨", "Pear", "d2", "v2", "u2", "aq2", "cq2"),
]
ITEM_SCHEMA = (
    "dataset string, category string, title string, intro string, image_dir string, pos int, slug string, zh string, en string, "
    "desc string, visual string, use string, asset_query string, chunk_query string"
)


def test_catalog(spark):
    assets, chunks, queries, docs = catalog.expand_catalog(spark.createDataFrame(ITEM, ITEM_SCHEMA), "v1", "Find by: {zh}, {en} ({title})")
    a = assets.orderBy("pos").first()
    assert (a.id, a.path, a.heading, a.anchor) == ("fruits.apple.image", "images/fruits/apple.png", "苹果 / Apple", "fruits.apple")
    assert chunks.orderBy("pos").first().asset_id == "fruits.apple.image"
    ids = [r.id for r in queries.orderBy("pos", "sub").collect()]
    assert ids == ["fruits_apple_asset", "fruits_apple_chunk", "fruits_pear_asset", "fruits_pear_chunk"]
    text = docs.first().text
    want = "\n".join(
        ["---", "title: 水果", "language: zh-CN", "source: local-synthetic", "modality: image-text", "version: v1", "category: fruits", "---", "",
         "# 水果", "", "intro", "",
         "## 苹果 / Apple", "", "Target: fruits.apple", "", "![苹果图片 - Apple](./images/fruits/apple.png)", "", "d1", "", "v1", "", "u1", "",
         "Find by: 苹果, Apple (水果)", ""]
    )
    assert text.startswith(want) and text.endswith("Find by: 梨, Pear (水果)\n")


def test_groups(spark):
    rows = [("d", "sets", "T", "intro", 1, "g1", "组", "Group", ["a.image", "b.image"], ["images/a.png", "images/b.png"], "s", "t", "cq", "aq")]
    schema = (
        "dataset string, doc string, title string, intro string, pos int, slug string, zh string, en string, assets array<string>, "
        "image_paths array<string>, summary string, detail string, chunk_query string, asset_query string"
    )
    chunks, queries, docs = catalog.expand_groups(spark.createDataFrame(rows, schema), "v1")
    c = chunks.first()
    assert (c.id, c.anchor, c.asset_ids) == ("groups.g1.text", "groups.g1", ["a.image", "b.image"])
    assert [(r.id, r.query_type) for r in queries.orderBy("sub").collect()] == [
        ("groups_g1_chunk", "text_chunk"), ("groups_g1_asset_group", "asset_group")
    ]
    assert "![组 / Group](./images/a.png)\n\n![组 / Group](./images/b.png)\n\ns\n\nt\n" in docs.first().text
    old = spark.createDataFrame([("groups.old",), ("fruits.a",), (None,)], "id string")
    assert curation.replace_by_prefix(old, chunks.select("id"), "groups.").count() == 3


def test_materialize(spark):
    results = [
        ("d", "t1", 1, 1, "succeeded", '{"text": "body"}'),
        ("d", "t2", 0, 5, "succeeded", '[{"stem": "One", "title": "T", "language": "ZH", "markdown": "# H"}, {"stem": "two", "markdown": " "}]'),
        ("d", "t3", 1, 2, "succeeded", '{"stem": "two", "markdown": "late"}'),
        ("d", "t4", 1, 3, "failed", '{"text": "x"}'),
        ("d", "t5", 1, 4, "succeeded", '{"stem": "one", "markdown": "dup"}'),
    ]
    r = spark.createDataFrame(results, "dataset string, task_id string, source_ord int, ord int, status string, result string")
    meta = spark.createDataFrame([("d", "t1", "Stem A", "en", "Title A")], "dataset string, task_id string, stem string, language string, title string")
    got = {x.stem: x.text for x in curation.materialize_corpus(r, meta, "src").collect()}
    assert got == {
        "stem-a": "---\ntitle: Title A\nlanguage: en\nsource: src\n---\n\n# Title A\n\nbody\n",
        "one": "---\ntitle: T\nlanguage: zh\nsource: src\n---\n\n# H\n",
    }


def test_clusters(spark):
    docs = spark.createDataFrame(
        [("d", "c", i, s, s.upper(), f"f{i}", "en", f"c-{s}") for i, s in enumerate("xyz")],
        "dataset string, cluster string, pos int, slug string, title string, focus string, language string, stem string",
    )
    assert {r.slug: r.siblings for r in curation.cluster_siblings(docs).collect()}["y"] == "X (f0); Z (f2)"
    listing = curation.cluster_listing(docs).first()
    assert listing["n"] == 3 and listing.listing.split("\n")[1] == "- stem=c-y | title=Y | focus: f1"
    cut = sorted((r.slug, r.part, r.siblings) for r in curation.cluster_siblings(docs, per_part=2).collect())
    assert cut == [("x", 0, "Y (f1)"), ("x", 1, "Z (f2)"), ("y", 0, "X (f0)"), ("y", 1, "Z (f2)"), ("z", 0, "X (f0); Y (f1)")]
    parts = sorted((r.part, r.parts, r["n"], r.listing) for r in curation.cluster_listing(docs, per_part=2).collect())
    assert [p[:3] for p in parts] == [(0, 2, 3), (1, 2, 3)]
    assert "\n".join(p[3] for p in parts) == listing.listing
    results = spark.createDataFrame(
        [("d", "t", "c", "succeeded", '[{"stem":"c-x","q":" ask "},{"stem":"c-q","q":"no"},{"stem":"c-y","q":""},{"stem":"c-z","q":"gone"}]')],
        "dataset string, task_id string, cluster string, status string, result string",
    )
    got = curation.materialize_cluster_queries(results, docs, corpus(spark, "c-x", "c-y")).collect()
    assert [(r.id, r.q, r.expect_any) for r in got] == [("en-c-x", "ask", ["c-x"])]


GOOD = "---\ntitle: t\n---\n\n# T\n\n## A\n\n" + "word " * 130


def test_quality_and_repair(spark):
    rows = [
        ("d", "en-synthetic-002", "en-synthetic-002.md", GOOD),
        ("d", "en-synthetic-004", "en-synthetic-004.md", "We need Let's"),
        ("d", "zh-synthetic-001", "zh-synthetic-001.md", "---\na\n---\n## x\n" + "中" * 200 + " word" * 37),
        ("d", "stray", "stray.md", " "),
    ]
    df = spark.createDataFrame(rows, X.CORPUS)
    got = {r.stem: r.reasons for r in quality.quality_reasons(df).collect()}
    assert got == {
        "en-synthetic-002": [],
        "en-synthetic-004": ["missing_frontmatter", "prompt_leak:We need", "too_few_english_words", "missing_section_heading"],
        "zh-synthetic-001": ["too_much_english_in_zh_doc"],
        "stray": ["noncanonical_filename", "empty", "missing_frontmatter", "missing_section_heading"],
    }
    audit = quality.audit_corpus(df).first()
    assert (audit.total, audit.canonical, audit.bad) == (4, 3, 3)
    rendered = quality.expected_grid(df.select("dataset").distinct(), 4).withColumn("text", F.concat(F.lit("new "), "stem"))
    fixed, moved, counts = quality.repair_corpus(df, rendered)
    texts = {r.stem: r.text for r in fixed.collect()}
    assert texts["en-synthetic-002"] == GOOD and texts["zh-synthetic-003"] == "new zh-synthetic-003"
    assert texts["en-synthetic-004"] == "new en-synthetic-004" and "stray" not in texts
    c = counts.first()
    assert (c.moved, c.repaired, c.total) == (1, 3, 4) and moved.count() == 1
    assert sorted(r.stem for r in quality.missing_documents(df, 4).collect()) == ["zh-synthetic-003"]


def test_siblings_of_all_parts(spark):
    """A document of a cluster of several parts is told of every other one, in its tasks too."""
    docs = spark.createDataFrame(
        [("d", "c", i, s, s.upper(), "f", "en") for i, s in enumerate("vwxyz")] + [("d", "one", 0, "a", "A", "f", "en")],
        "dataset string, cluster string, pos int, slug string, title string, focus string, language string",
    )
    got = curation.cluster_siblings(docs, per_part=2).collect()
    told = {}
    for r in sorted(got, key=lambda r: (r.cluster, r.slug, r.part)):
        told.setdefault(r.slug, []).append(r.siblings)
    assert told.pop("a") == [""]
    for slug in "vwxyz":
        assert "; ".join(told[slug]) == "; ".join(f"{o.upper()} (f)" for o in "vwxyz" if o != slug)
    tasks = curation.cluster_doc_tasks(docs, "v1", "sys", "{title}: {siblings}", per_part=2).collect()
    assert sorted(t.user for t in tasks if t.stem == "c-v") == ["V: W (f)", "V: X (f); Y (f)", "V: Z (f)"]
    assert len({t.task_id for t in tasks}) == len(tasks)


def test_sibling_texts_are_not_shuffled(spark):
    """Texts of a cluster grow with its square: no exchange may carry them."""
    shape = "dataset string, cluster string, pos int, slug string, title string, focus string, language string"
    docs = spark.createDataFrame([("d", "c", i, f"s{i:02d}", f"T{i}", "f", "en") for i in range(40)] + [("d", "one", 0, "a", "A", "f", "en")], shape)
    laid = curation.cluster_siblings_laid(docs, per_part=3)
    want = {f"s{i:02d}": "; ".join(f"T{o} (f)" for o in range(40) if o != i) for i in range(40)} | {"a": ""}
    assert {r.slug: r.siblings for r in laid.collect()} == want
    for df in (laid, curation.cluster_doc_tasks(docs, "v1", "sys", "{title}: {siblings}", per_part=3)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        above = plan[: plan.index("Join")]
        assert "Aggregate" not in above and "siblings" in above
