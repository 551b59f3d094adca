"""What written tables leave behind."""

from __future__ import annotations

import pathlib

from pyspark.sql import functions as F

from eventlift.llm.tables import setting, written


def _shuffled(spark) -> int:
    """Files of shuffles in Spark's own folders."""
    utils = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(len(list(pathlib.Path(f.getPath()).rglob("shuffle_*"))) for f in utils.localDirs())


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = _shuffled(spark)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    usual = spark.conf.get(key)
    frame = spark.range(1000).withColumn("k", F.col("id") % 7)
    out = written(frame.groupBy("k").agg(F.sum("id").alias("n")).repartition(3, "n"), "left-behind")
    assert _shuffled(spark) <= before
    assert spark.conf.get(key) == usual
    assert {(r["k"], r["n"]) for r in out.collect()} == {(k, sum(range(k, 1000, 7))) for k in range(7)}


def test_settings_are_put_back(spark):
    spark.conf.unset("eventlift.test")
    with setting(spark, "eventlift.test", "a"):
        with setting(spark, "eventlift.test", "b"):
            assert spark.conf.get("eventlift.test") == "b"
        assert spark.conf.get("eventlift.test") == "a"
    assert spark.conf.get("eventlift.test", None) is None
