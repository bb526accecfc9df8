"""Column functions against the same computation in plain Python."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qrelmill.functions import jsontext as J
from qrelmill.functions import text as T
from qrelmill.operators import corpus as C

DOC = """---
title: A: b
language:  ZH-cn 
source: s
---

# Title

## One
Target: a.b
![x](./images/x.png "t")

##   Two  
body
## One
last ![y](images/y.png)
"""


def one(spark, text, *cols):
    return spark.createDataFrame([(text, "zh-synthetic-001.md")], "text string, file_name string").select(*cols).first()


def test_structure(spark):
    row = one(
        spark,
        DOC,
        T.headings(F.col("text")).alias("h"),
        T.target_markers(F.col("text")).alias("t"),
        T.image_refs(F.col("text")).alias("i"),
        T.document_language(F.col("text"), F.col("file_name")).alias("l"),
        T.front_matter(F.col("text")).alias("f"),
        T.section_list(F.col("text")).alias("s"),
    )
    assert row.h == ["One", "Two  ", "One"]
    assert row.t == ["a.b"]
    assert [(x.alt, x.path) for x in row.i] == [("x", "./images/x.png"), ("y", "images/y.png")]
    assert row.l == "zh-cn"
    assert row.f == {"title": "A: b", "language": "ZH-cn", "source": "s"}
    assert [s.heading for s in row.s] == ["Two", "One"]
    assert row.s[1].section_text == "## One\nlast ![y](images/y.png)"


def test_language_falls_back_to_prefix(spark):
    df = spark.createDataFrame(
        [("x", "zh-a.md"), ("x", "en-a.md"), ("x", "a.md"), ("language: en\n", "zh-a.md")], "t string, n string"
    )
    got = [r[0] for r in df.select(T.document_language(F.col("t"), F.col("n"))).collect()]
    assert got == ["zh", "en", "", "en"]


TEXTS = st.lists(
    st.text(alphabet="ab# -_中é\n\r\t\x0b\x1c\x85\u2028\u3000![](.)", max_size=40), min_size=1, max_size=30
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    t = F.col("t")
    rows = df.select(
        "i",
        T.strip(t).alias("strip"),
        T.split_lines(t).alias("lines"),
        T.strip_front_matter(t).alias("body"),
        T.headings(t).alias("heads"),
        T.word_count(t, 2).alias("w2"),
        T.section_list(t).alias("secs"),
        F.regexp_count(t, F.lit("\n## ")).alias("h2"),
    ).collect()
    for r in rows:
        s = texts[r.i]
        assert r.strip == s.strip()
        assert r.lines == s.splitlines()
        parts = s.split("---", 2)
        assert r.body == (parts[2] if s.startswith("---") and len(parts) == 3 else s)
        heading = re.compile(r"^##\s+(.+)$", re.M)
        assert r.heads == heading.findall(s)
        assert r.w2 == len(re.findall(r"\b[A-Za-z]{2,}\b", s))
        assert r.h2 == s.count("\n## ")
        found = list(heading.finditer(s))
        want = {}
        for m, after in zip(found, [*[x.start() for x in found[1:]], len(s)]):
            want[m.group(1).strip()] = s[m.start() : after].strip()
        assert {x.heading: x.section_text for x in r.secs} == want


def test_truncate_and_stems(spark):
    df = spark.createDataFrame([(" Ab c--中D-",), ("",), ("中",)], "v string")
    assert [r[0] for r in df.select(T.safe_stem(F.col("v"))).collect()] == ["ab-c-d", "synthetic-doc", "synthetic-doc"]
    row = one(spark, "中文中文", T.truncate(F.col("text"), 3).alias("a"), T.truncate(F.col("text"), 4).alias("b"))
    assert row.a == "中文中\n...[truncated]" and row.b == "中文中文"
    names = spark.createDataFrame([("zh-synthetic-001.md",), ("a.b.md",), ("en-synthetic-01.md",)], "n string")
    got = names.select(T.is_canonical(F.col("n")), T.stem(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(True, "zh-synthetic-001"), (False, "a.b"), (False, "en-synthetic-01")]


def test_markers(spark):
    rows = [
        ("d", "zh-synthetic-001", "zh-synthetic-001.md", "# T\nbody\n"),
        ("d", "en-synthetic-002", "en-synthetic-002.md", "no title  \n"),
        ("d", "en-synthetic-003", "en-synthetic-003.md", "# x docmarkensynthetic003"),
        ("d", "other", "other.md", "# T\n"),
    ]
    df = spark.createDataFrame(rows, "dataset string, stem string, file_name string, text string")
    got = {r.stem: (r.text, r.changed) for r in C.stamp_markers(df).collect()}
    assert got["zh-synthetic-001"] == ("# T\n\n检索标记：docmarkzhsynthetic001。\nbody\n", True)
    assert got["en-synthetic-002"] == ("no title\n\nRetrieval marker: docmarkensynthetic002.\n", True)
    assert not got["en-synthetic-003"][1] and not got["other"][1]


def test_blocks(spark):
    text = "# A\n\n## B  \n### C\n![alt](p.png \"t\")\nTarget: x\n plain\nsee ![a](b)\n"
    df = spark.createDataFrame([("d", "s", text)], "dataset string, stem string, text string")
    got = [(r.line_no, r.kind, r.content, r.path) for r in C.markdown_blocks(df).orderBy("line_no").collect()]
    assert got == [
        (0, "h1", "A", None),
        (2, "h2", "B", None),
        (3, "h3", "C", None),
        (4, "image", "alt", "p.png"),
        (5, "target", "Target: x", None),
        (6, "paragraph", " plain", None),
        (7, "paragraph", "see ![a](b)", None),
    ]


def test_extract_json(spark):
    cases = [
        ('```json\n{"a": 1}\n```', '{"a": 1}'),
        ("text ```[1]``` x", "[1]"),
        (' {"a": 1} ', '{"a": 1}'),
        ('see {"a": [1]} end', '{"a": [1]}'),
        ('see [1, {"a": 2}] end }', '[1, {"a": 2}]'),
        ("} nothing {", "} nothing {"),
        ("plain", "plain"),
    ]
    df = spark.createDataFrame([(a,) for a, _ in cases], "t string")
    assert [r[0] for r in df.select(J.extract_json_text(F.col("t"))).collect()] == [b for _, b in cases]
    bad = spark.createDataFrame([("nope",), ("3",), ('{"a":1}',)], "t string")
    got = [r[0] for r in bad.select(J.parse_model_json(F.col("t"))["error"]).collect()]
    assert got == [J.PARSE_FAILED, J.BAD_ROOT, None]


def test_coerce_list(spark):
    cases = [
        ('[" a ", "", 3]', ["a", "3"]),
        ('"[a, \\"b\\"\\nc]"', ["a", "b", "c"]),
        ("null", []),
        ("7", []),
        ('"[]"', []),
    ]
    df = spark.createDataFrame([(a,) for a, _ in cases], "t string")
    got = [r[0] for r in df.select(J.coerce_string_list(F.try_parse_json(F.col("t")))).collect()]
    assert got == [b for _, b in cases]


def test_tokens(spark):
    row = one(spark, "Hello 中文词 x 单 é2", T.tokenize(F.col("text")).alias("t"))
    assert row.t == ["hello", "中文", "文词", "x", "单", "é2"]


def test_pack(spark):
    rows = [("d", "b", "b.md", "B"), ("d", "a", "a.md", "A"), ("e", "c", "c.md", "C")]
    df = spark.createDataFrame(rows, "dataset string, stem string, file_name string, text string")
    packs = {r.dataset: r.pack for r in C.assemble_packs(C.corpus_pack(df)).collect()}
    assert packs == {"d": "\n\n# STEM: a\nA\n\n# STEM: b\nB", "e": "\n\n# STEM: c\nC"}
    parts = sorted((r.dataset, r.part, r.parts, r.pack) for r in C.assemble_packs(C.corpus_pack(df), per_part=1).collect())
    assert [p[:3] for p in parts] == [("d", 0, 2), ("d", 1, 2), ("e", 0, 1)]
    assert parts[0][3] + parts[1][3] == packs["d"]
