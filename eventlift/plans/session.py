"""Session settings for the spark-submit entry points."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(name: str) -> SparkSession:
    """A session in UTC; what the cluster already set for checkpoints is kept.

    Shuffle width is left to the cluster and adaptive execution.  A streaming query
    fixes its width at the first checkpoint, so set ``spark.sql.shuffle.partitions``
    for the cluster before the first start.  The method limit is the JVM's: a stage whose
    generated method is longer would run uncompiled, so Spark splits it instead.
    """
    return (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession, given: str | None) -> str:
    """The given folder, or a sub-folder of the cluster's shared checkpoint folder."""
    if given:
        return given
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/eventlift"
    raise ValueError("give --checkpoints or set spark.checkpoint.dir to a shared folder")
