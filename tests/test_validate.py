"""One mutation per check over a small clean package."""

import pytest

from qrelmill import schemas as X
from qrelmill.operators import validate as V

TEXT = "# Doc\n\n## Fruit Group\n\nTarget: groups.fruit\n\n![a](./images/a.png)\n\n![b](images/b.png \"t\")\n"


def tables(**changes):
    rows = {
        "datasets": [("d", "about", True, True, True, True)],
        "thresholds": [("d", 0, "mrr", 0.5, True)],
        "queries": [("d", 1, True, "q1", "what?", None, ["doc"], "list", False, None, "absent", None, "absent")],
        "assets": [
            ("d", 1, True, "fruits.apple.image", "doc", "images/a.png", "Fruit Group", "x"),
            ("d", 2, True, "fruits.banana.image", "doc", "./images/b.png", "Fruit Group", "x"),
        ],
        "chunks": [
            ("d", 1, True, "groups.fruit.text", "doc", "Fruit Group", "groups.fruit", None,
             ["fruits.apple.image", "fruits.banana.image"], "list")
        ],
        "corpus": [("d", "doc", "doc.md", TEXT)],
        "asset_files": [("d", "images/a.png", 1), ("d", "images/b.png", 1)],
    }
    rows.update(changes)
    return rows


def package(spark, cases):
    """All cases as packages of one set of tables, named by their number."""
    shape = {
        "datasets": X.DATASETS, "thresholds": X.THRESHOLDS, "queries": X.QUERIES, "assets": X.ASSETS,
        "chunks": X.CHUNKS, "corpus": X.CORPUS, "asset_files": X.ASSET_FILES,
    }
    merged = {k: [(f"p{n:02d}", *r[1:]) for n, rows in enumerate(cases) for r in rows[k]] for k in shape}
    return V.Package(**{k: spark.createDataFrame(merged[k], shape[k]) for k in shape})


def chunk(**kw):
    base = dict(dataset="d", pos=1, ok=True, id="c", doc="doc", heading="Fruit Group", anchor="groups.fruit", asset_id=None, asset_ids=["fruits.apple.image"], kind="list")
    base.update(kw)
    return [tuple(base.values())]


def asset(**kw):
    base = dict(dataset="d", pos=1, ok=True, id="fruits.apple.image", doc="doc", path="images/a.png", heading="Fruit Group", anchor="x")
    base.update(kw)
    return [tuple(base.values()), ("d", 2, True, "fruits.banana.image", "doc", "images/b.png", "Fruit Group", "x")]


def query(*rows):
    base = dict(dataset="d", pos=1, ok=True, id="q1", q="what?", t=None, any=["doc"], ak="list", none=False, aa=None, aak="absent", ca=None, cak="absent")
    return [tuple({**base, "pos": i + 1, **r}.values()) for i, r in enumerate(rows)]


A, B, C = "asset target #1 ", "chunk target #1 ", "query #1 "
CASES = [
    (dict(datasets=[("d", "", False, True, True, True)]), ["missing dataset.yaml"]),
    (dict(datasets=[("d", "", True, False, True, True)]), ["missing queries.yaml"]),
    (dict(datasets=[("d", "", True, True, True, False)]), ["missing corpus/"]),
    (dict(assets=[]), ["targets.yaml must contain non-empty assets list"]),
    (dict(chunks=[]), ["targets.yaml must contain non-empty chunks list"]),
    (dict(assets=asset(ok=False)), [A + "must be a mapping", B + "references missing asset target: fruits.apple.image"]),
    (dict(assets=asset(path="")), [A + "has empty path"]),
    (dict(assets=asset(path="images/z.png")), [A + "references missing file: images/z.png"]),
    (dict(assets=asset(doc="ghost")), [A + "references missing doc: ghost"]),
    (dict(assets=asset(heading="")), [A + "has empty heading"]),
    (dict(assets=asset(heading="Nope")), [A + "heading not found in doc.md: Nope"]),
    (dict(chunks=chunk(ok=False)), [B + "must be a mapping"]),
    (dict(chunks=chunk(id="")), [B + "has empty id"]),
    (dict(chunks=chunk(doc="ghost", heading="")), [B + "references missing doc: ghost"]),
    (dict(chunks=chunk(heading="Nope")), [B + "heading not found in doc.md: Nope"]),
    (dict(chunks=chunk(anchor="no")), [B + "anchor not found in doc.md: no"]),
    (dict(chunks=chunk(asset_id="fruits.apple.image")), [B + "must not set both asset_id and asset_ids"]),
    (dict(chunks=chunk(asset_ids=[], kind="bad")), [B + "asset_ids must be a non-empty list"]),
    (dict(chunks=chunk(asset_ids=None, kind="absent")), [B + "has empty asset_id"]),
    (dict(chunks=chunk(asset_ids=["", "x"])), [B + "asset_ids contains empty id", B + "references missing asset target: x"]),
    (dict(corpus=[("d", "doc", "doc.md", TEXT + "![r](https://x/y.png) ![m](images/m.png)")]),
     ["doc.md uses remote image reference: https://x/y.png", "doc.md references missing image: images/m.png"]),
    (dict(thresholds=[("d", 0, "map", None, False)]), ["unknown threshold key: map", "threshold map must be numeric"]),
    (dict(queries=[]), ["queries.yaml must contain non-empty queries list"]),
    (dict(queries=query(dict(ok=False))), [C + "must be a mapping"]),
    (dict(queries=query(dict(id=" "))), [C + "has empty id"]),
    (dict(queries=query({}, dict(q="b"))), ["duplicate query id: q1"]),
    (dict(queries=query({}, dict(id="q2"))), ["duplicate query text: what?"]),
    (dict(queries=query({}, {})), ["duplicate query id: q1", "duplicate query text: what?"]),
    (dict(queries=query(dict(q=""))), [C + "has empty q"]),
    (dict(queries=query(dict(none=True))), [C + "has both expect_any and expect_none"]),
    (dict(queries=query(dict(any=None, ak="absent"))), [C + "must set expect_any or expect_none"]),
    (dict(queries=query(dict(any=None, ak="other"))), [C + "expect_any must be a list"]),
    (dict(queries=query(dict(any=["doc", "x"]))), [C + "references missing stem: x"]),
    (dict(queries=query(dict(aa=[], aak="bad"))), [C + "expect_asset_any must be a non-empty list"]),
    (dict(queries=query(dict(aa=["z"], aak="list", ca=["z"], cak="list"))),
     [C + "references missing asset target: z", C + "references missing chunk target: z"]),
    (dict(queries=query(dict(aa=["z"], aak="list")), datasets=[("d", "", True, True, False, True)]), []),
]


CASES += [
    ({}, []),
    (dict(chunks=[("d", 1, True, "c", "doc", "Fruit Group", "groups.fruit", "fruits.apple.image", None, "absent")]), []),
    (dict(corpus=[], datasets=[("d", "", True, True, False, True)]),
     ["corpus/ has no markdown files", "query #1 references missing stem: doc"]),
    (dict(assets=[("d", 1, True, "", "doc", "images/a.png", "Fruit Group", "x")]), ["asset target #1 has empty id"]),
]


def test_violations(spark):
    pkg = package(spark, [tables(**changes) for changes, _ in CASES])
    found = V.validate_packages(pkg).persist()
    got = {}
    for r in found.orderBy("dataset", "section", "pos", "sub").collect():
        got.setdefault(r.dataset, []).append(r.message)
    for n, (changes, want) in enumerate(CASES):
        assert got.get(f"p{n:02d}", []) == want, (n, changes)
    verdict = {r.dataset: (r.n_violations, r.valid) for r in V.package_verdict(pkg, found).collect()}
    assert verdict == {f"p{n:02d}": (len(w), not w) for n, (_, w) in enumerate(CASES)}


@pytest.mark.parametrize("name", ["asset_documents", "chunk_documents"])
def test_single_checks_equal_their_part_of_the_union(spark, name):
    pkg = package(spark, [tables(**changes) for changes, _ in CASES[8:22]])
    section = V.ASSET if name.startswith("asset") else V.CHUNK
    alone = sorted((r.dataset, r.message) for r in V.CHECKS[name](pkg).collect())
    both = V.check_targets(pkg, fields=False).where(f"section = {section}")
    assert alone == sorted((r.dataset, r.message) for r in both.collect()) and alone


def test_hot_duplicate_text(spark):
    rows = [("d", i, True, f"q{i}", "same" if i % 3 else f"t{i}", None, ["doc"], "list", False, None, "absent", None, "absent") for i in range(1, 3001)]
    pkg = package(spark, [tables(queries=rows)])
    out = V.check_query_duplicates(pkg)
    assert out.count() == 1999 and out.agg({"pos": "min"}).first()[0] == 2


def test_coverage(spark):
    pkg = package(spark, [tables()])
    row = V.coverage_balance(pkg.corpus, pkg.queries).first()
    assert (row.uncovered, row.n_zh, row.n_en, row.accepted) == (0, 0, 0, True)
