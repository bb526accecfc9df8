"""The quality rules read whole texts, so they are applied once for both sides."""

from pyspark.sql import functions as F

from qrelmill.operators import quality
from qrelmill.sources import sinks


def test_rules_are_applied_once(spark, tmp_path):
    rows = [("d", "stray", "stray.md", "We need Let's"), ("d", "en-synthetic-002", "en-synthetic-002.md", "---\nt\n---\n\n## A\n\n" + "word " * 130)]
    df = spark.createDataFrame(rows, "dataset string, stem string, file_name string, text string")
    clean, bad = quality.split_clean(df)
    kept = sinks.quarantine(quality.quality_reasons(df), str(tmp_path / "q"), "1", apply=True)
    for side, stems in ((clean, ["en-synthetic-002"]), (bad, ["stray"]), (kept, ["en-synthetic-002"])):
        assert [r.stem for r in side.collect()] == stems
        assert "prompt_leak" not in side._jdf.queryExecution().optimizedPlan().toString()
    moved = spark.read.parquet(str(tmp_path / "q" / "run_ts=1"))
    assert [r.stem for r in moved.select(F.col("stem")).collect()] == ["stray"]
