"""Event files and the partitioned raw lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlift import schema


def read_event_files(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited JSON, one event per line; a bad field becomes NULL."""
    return spark.read.schema(schema.EVENT).json(path)


def stream_event_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema.EVENT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def read_raw_lake(spark: SparkSession, path: str) -> DataFrame:
    """The whole lake under ``path``.

    Reading the root, not a file pattern, lets Spark discover the
    ``event_date=/event_hour=`` folders for partition pruning and honour the file
    sink's commit log, so files of failed micro-batches stay invisible.
    """
    return spark.read.schema(schema.RAW).parquet(path)


def stream_raw_lake(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema.RAW)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
