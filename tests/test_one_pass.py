"""A text is gone over once."""

import re

from pyspark.sql import functions as F

from qrelmill.functions import text as T


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_safe_stem_is_one_pass(spark):
    texts = ["", " ", "--", "_", "-_-", " -a- ", " A\u0085b--C ---\td\n", "a- -b", "İx", "中a中", "a__b", "\x1c-x\x1f-", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string").select("i", T.safe_stem(F.col("v")).alias("s"))
    assert _plan(got).count("regexp_replace") == 1

    def plain(text):
        slug = re.sub(r"-{2,}", "-", re.sub(r"[^a-z0-9_-]+", "-", text.strip().lower())).strip("-")
        return slug or T.DEFAULT_STEM

    assert {r.i: r.s for r in got.collect()} == {i: None if t is None else plain(t) for i, t in enumerate(texts)}
