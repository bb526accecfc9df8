"""Ranking metrics and separation at known ranks."""

import math

import pytest
from pyspark.sql import functions as F

from qrelmill.functions import ranking as R
from qrelmill.operators import scoring
from qrelmill.operators import separation as S

ROWS = [
    ("r", "zh-a", ["doc_a"], ["doc_a", "x", "y"]),
    ("r", "zh-b", ["doc_b"], ["x", "doc_b", "y"]),
    ("r", "en-c", ["doc_c"], ["x", "y", "z", "doc_c"]),
    ("r", "en-d", ["doc_d"], ["x", "y", "z"]),
]
SCHEMA = "run_id string, id string, expect_any array<string>, ranked array<string>"


def python_metrics(ranked, expect):
    want = set(expect)
    dcg = sum(1 / math.log2(i + 2) for i, d in enumerate(ranked[:10]) if d in want)
    ideal = sum(1 / math.log2(i + 1) for i in range(1, min(len(want), 10) + 1))
    return [
        float(any(e in ranked[:3] for e in expect)),
        float(any(e in ranked[:10] for e in expect)),
        next((1 / (i + 1) for i, d in enumerate(ranked) if d in want), 0.0),
        dcg / ideal if want else 0.0,
        len(set(ranked[:100]) & want) / len(want) if want else 0.0,
    ]


def test_split_metrics(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {r.lang: r for r in scoring.split_metrics(df).collect()}
    assert {k: r.n for k, r in got.items()} == {"all": 4, "zh": 2, "en": 2}
    zh, en = got["zh"], got["en"]
    assert (zh.hit_at_3, zh.mrr, zh.recall_at_100) == (1.0, 0.75, 1.0)
    assert zh.ndcg_at_10 == pytest.approx((1 + 1 / math.log2(3)) / 2)
    assert (en.hit_at_3, en.hit_at_10, en.mrr) == (0.0, 0.5, 0.125)
    assert en.ndcg_at_10 == pytest.approx((1 / math.log2(5)) / 2)
    whole = scoring.aggregate_metrics(df).first()
    for m in R.METRICS:
        assert got["all"][m] == pytest.approx(whole[m])


def test_edge_rows_match_python(spark):
    rows = [
        ("r", "1", [], ["a"]),
        ("r", "2", ["a"], []),
        ("r", "3", ["a", "a", "b"], ["x", "a", "a", "b"]),
        ("r", "4", [str(i) for i in range(15)], [str(i) for i in range(14, -1, -1)]),
        ("r", "5", ["q"], [str(i) for i in range(120)] + ["q"]),
    ]
    df = scoring.query_metrics(spark.createDataFrame(rows, SCHEMA))
    for r in df.collect():
        assert [r[m] for m in R.METRICS] == pytest.approx(python_metrics(r.ranked, r.expect_any)), r.id


def test_no_rows_and_small_k(spark):
    empty = spark.createDataFrame([], SCHEMA)
    row = scoring.aggregate_metrics(empty).first()
    assert [row[m] for m in R.METRICS] == [0.0] * 5 and row.n == 0
    one = spark.createDataFrame(ROWS[:1], SCHEMA)
    a, b = F.col("ranked"), F.col("expect_any")
    assert list(one.select(R.hit_at_k(a, b, 0), R.ndcg_at_k(a, b, 0), R.recall_at_k(a, b, 0)).first()) == [0, 0, 0]
    assert one.select(R.lang_bucket(F.lit("sci_q1"))).first()[0] == "other"


def test_partitioning_does_not_matter(spark):
    df = spark.createDataFrame(ROWS * 5, SCHEMA)
    a = sorted(map(tuple, scoring.split_metrics(df.repartition(1)).collect()))
    b = sorted(map(tuple, scoring.split_metrics(df.repartition(7)).collect()))
    assert [x[:3] for x in a] == [x[:3] for x in b]
    for x, y in zip(a, b):
        assert x[3:] == pytest.approx(y[3:])


def test_views_and_report(spark):
    rows = [("r", "hybrid", "zh-a", ["a"], ["a"], ["i"], ["z", "i"]), ("r", "hybrid", "en-b", ["b"], ["a"], None, None)]
    df = spark.createDataFrame(
        rows,
        "run_id string, mode string, id string, expect_any array<string>, ranked array<string>, "
        "expect_asset_any array<string>, ranked_assets array<string>",
    )
    got = {(r.view, r.lang): r for r in scoring.mode_view_metrics(df).collect()}
    assert got["doc", "all"].n == 2 and got["doc", "all"].mrr == 0.5
    assert got["asset", "all"].n == 1 and got["asset", "zh"].mrr == 0.5 and ("asset", "en") not in got
    lines = [r.line for r in scoring.metrics_report(scoring.split_metrics(df)).orderBy("ord").collect()]
    assert lines[0] == "### r" and lines[1] == "" and lines[3] == "|---|---|---|---|---|---|---|"
    assert lines[4] == "| all | 2 | 0.500 | 0.500 | 0.500 | 0.500 | 0.500 |"


def test_graded_metrics_agree(spark):
    df = scoring.query_metrics(spark.createDataFrame(ROWS, SCHEMA))
    judged = df.select(
        "id",
        *[F.col(m).alias(f"x_{m}") for m in R.METRICS],
        F.transform("ranked", lambda d: F.array_contains("expect_any", d)).alias("relevant"),
        F.size("expect_any").alias("wanted"),
    )
    for r in scoring.graded_metrics(judged).collect():
        assert [r[m] for m in R.METRICS] == pytest.approx([r[f"x_{m}"] for m in R.METRICS])


def probe(spark, raws):
    df = spark.createDataFrame([(r,) for r in raws], "j string")
    return [r[0] for r in df.select(S.top1_score(F.parse_json("j"))).collect()]


def test_top1_score(spark):
    assert probe(
        spark,
        ['{"scores":[0.9,0.1]}', '{"ranked_scores":[0.5]}', '{"top1_score":0.7}', "{}", '{"scores":[]}',
         '{"top1_score":true}', '{"top1_score":"0.5","scores":["x"],"hit_scores":[2]}'],
    ) == [0.9, 0.5, 0.7, None, None, None, 2.0]


def sides(spark, pos, neg):
    schema = "run_id string, pos int, q string, ranked array<string>, score double"
    make = lambda xs: spark.createDataFrame([("r", i, f"q{i}", [f"d{i}"], s) for i, s in enumerate(xs)], schema)
    return make(pos), make(neg)


def test_separation(spark):
    pos, neg = sides(spark, [0.81, 0.79], [0.22, 0.18])
    r = S.separation(pos, neg).first()
    assert r.scores_available and r.positives == 2 and r.negatives == 2
    assert r.pos_mean == pytest.approx(0.80) and r.neg_mean == pytest.approx(0.20)
    assert r.separation_margin == pytest.approx(0.60) and r.cutoff == pytest.approx(0.50)
    assert r.expect_none_satisfaction == 1.0
    assert S.separation(pos, neg, cutoff=0.20).first().expect_none_satisfaction == 0.5
    assert S.separation(pos, neg, cutoff=0.18).first().expect_none_satisfaction == 0.0
    lines = [x.line for x in S.separation_report(S.separation(pos, neg)).orderBy("ord").collect()]
    assert lines[-1] == "- expect_none satisfaction @ cutoff 0.5000: 1.000"


def test_separation_without_scores(spark):
    pos, neg = sides(spark, [0.8, None], [None, None])
    r = S.separation(pos, neg).first()
    assert not r.scores_available and (r.positives, r.negatives) == (2, 2)
    assert r.pos_mean is None and r.expect_none_satisfaction is None
    leaks = S.leak_sample(neg)
    assert leaks.orderBy("pos").first().top_stem == "d0"
    lines = [x.line for x in S.separation_report(S.separation(pos, neg), leaks).orderBy("ord").collect()]
    assert "scores unavailable" in lines[3] and lines[5] == "  - `q0` -> `d0`"


def test_exact_median_on_skewed_values(spark):
    values = [float(v) for v in [0] * 40_000 + list(range(1, 30_000)) + [10**12]]
    df = spark.createDataFrame([("r", v) for v in values], "run_id string, score double")
    import statistics

    row = S.score_summary(df, ["run_id"]).first()
    assert row.median == statistics.median(values) and row["n"] == len(values)
    more = [float((i * 7919) % 100_003) for i in range(60_000)]
    row = S.score_summary(spark.createDataFrame([("r", v) for v in more], "run_id string, score double"), ["run_id"]).first()
    assert row.median == statistics.median(more)
