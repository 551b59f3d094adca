"""Intermediate tables in the shared folder, and small helpers for inputs."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset (tests), a temporary one is set for the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="eventlift-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """A setting of the session for what runs inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to a new table in the shared folder and read it back, which cuts its lineage.

    What was shuffled for it is deleted once it is written, as nothing reads that again.
    """
    path = new_path(df.sparkSession, name)
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(*tables: DataFrame) -> None:
    """Delete the files of tables of ``written`` that nothing reads any more."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def batch_rows(spark: SparkSession, n: int) -> contextlib.AbstractContextManager[None]:
    """Arrow batches of ``n`` rows at most for what is written inside, as rows with whole texts fill memory."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", n)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
