import os
from urllib.parse import urlparse

from pyspark.sql import functions as F

from qrelmill.llm import jaccard_join
from qrelmill.llm.work import Work
from tests.llm.util import awkward

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_a_saved_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    sums = spark.range(5000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    saved = Work(spark, "test").save(sums.join(spark.range(7).withColumnRenamed("id", "k").hint("merge"), "k"), "sums")
    assert not shuffle_files(spark) - before
    assert saved.count() == 7 and spark.conf.get(CLEANUP, None) == setting


def test_near_copies_keep_only_tables_that_are_read(spark, monkeypatch):
    made = []
    monkeypatch.setattr(jaccard_join, "Work", lambda *a: made.append(Work(*a)) or made[-1])
    found = jaccard_join.jaccard_components(awkward(spark), 5, 80)
    left = set(os.listdir(urlparse(made[0].root).path))
    assert not left & {"members", "cut", "texts", "inside", "rooted", "others"}
    assert found.count() == awkward(spark).count()
