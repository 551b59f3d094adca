"""Versioned tables under one root, published together by swapping a manifest.

A run writes every table it makes into a folder of its own, ``<root>/<table>/run=<id>``, and touches
nothing that readers use.  What a table consists of stands in ``<root>/_manifest.json``: one folder, or for
tables by day one folder a day, which may come from different runs.  Publishing replaces that file by
rename, which HDFS and local file systems do atomically, so readers see all tables of the old state or
all of the new one, and a run that fails half way changes nothing.  ``vacuum`` removes folders that the
manifest does not name.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFEST = "_manifest.json"
DAY = "event_date"


class StaleManifest(RuntimeError):
    """Another run has published since this one began."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it does not exist."""
    files = _files(spark, path)
    if not files.exists(_path(spark, path)):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(_path(spark, path)) if s.isDirectory())


def read_json(spark: SparkSession, path: str) -> dict | None:
    files = _files(spark, path)
    if not files.exists(_path(spark, path)):
        return None
    stream = files.open(_path(spark, path))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def swap_json(spark: SparkSession, path: str, content: dict) -> None:
    """Replace a small file by rename; readers find the old or the new content, never a part."""
    files, jvm = _files(spark, path), spark._jvm
    fresh = f"{path}.{uuid.uuid4().hex}"
    out = files.create(_path(spark, fresh), True)
    out.write(json.dumps(content, indent=1).encode())
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(_path(spark, fresh)), files.makeQualified(_path(spark, path)), overwrite)


class Publication:
    """One run over the tables of a root: write and read new versions, then publish or let go."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.run = spark, root.rstrip("/"), uuid.uuid4().hex
        self.before = read_json(spark, f"{self.root}/{MANIFEST}") or {"version": None, "tables": {}}
        self.tables = dict(self.before["tables"])

    def write(
        self,
        name: str,
        df: DataFrame,
        *,
        by_day: bool = False,
        days: tuple[dt.date, dt.date] | None = None,
        gather: bool = False,
    ) -> DataFrame:
        """Write a new version of a table and read it as it will be published.

        With ``days`` (first, last) only those days are replaced, and only by what ``df`` holds of them; days of
        the range without rows are gone in the new version.  ``gather`` brings the rows of a day together
        first, in tasks of even size, where otherwise every task would write a file into every day.
        """
        folder = f"{name}/run={self.run}"
        writer = (df.hint("rebalance", DAY) if gather else df).write.mode("overwrite")
        (writer.partitionBy(DAY) if by_day else writer).parquet(f"{self.root}/{folder}")
        parts = {"": folder}
        if by_day:
            written = folders(self.spark, f"{self.root}/{folder}")
            parts = {d.partition("=")[2]: f"{folder}/{d}" for d in written if d.startswith(f"{DAY}=")}
            if days is not None:
                first, last = (str(d) for d in days)
                old = self.tables.get(name, {"parts": {}})["parts"]
                parts = {d: p for d, p in old.items() if not first <= d <= last} | parts
        self.tables[name] = {"schema": df.schema.jsonValue(), "parts": parts}
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        """A table as this run sees it, whether published yet or not."""
        return _read(self.spark, self.root, name, self.tables[name])

    def publish(self) -> None:
        path = f"{self.root}/{MANIFEST}"
        now = read_json(self.spark, path) or {"version": None}
        if now["version"] != self.before["version"]:
            raise StaleManifest(f"{path} is now of run {now['version']}")
        swap_json(self.spark, path, {"version": self.run, "tables": self.tables})


def _read(spark: SparkSession, root: str, name: str, entry: dict) -> DataFrame:
    schema = T.StructType.fromJson(entry["schema"])
    if not entry["parts"]:
        return spark.createDataFrame([], schema)
    given = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    paths = [f"{root}/{p}" for _, p in sorted(entry["parts"].items())]
    return spark.read.schema(given).option("basePath", f"{root}/{name}").parquet(*paths).select(*schema.names)


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of the manifest."""
    root = root.rstrip("/")
    manifest = read_json(spark, f"{root}/{MANIFEST}") or {"tables": {}}
    return {name: _read(spark, root, name, entry) for name, entry in manifest["tables"].items()}


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete the folders that the manifest does not name; returns how many.

    Not while a run is writing or a reader still works on an older state.
    """
    root, removed = root.rstrip("/"), 0
    manifest = read_json(spark, f"{root}/{MANIFEST}")
    if manifest is None:
        return 0
    used = {p for entry in manifest["tables"].values() for p in entry["parts"].values()}
    for name in folders(spark, root):
        for run in [r for r in folders(spark, f"{root}/{name}") if r.startswith("run=")]:
            inside = [f"{name}/{run}/{d}" for d in folders(spark, f"{root}/{name}/{run}")]
            keep = {f"{name}/{run}", *inside} & used
            for path in [f"{name}/{run}"] if not keep else [] if f"{name}/{run}" in keep else [d for d in inside if d not in keep]:
                _files(spark, root).delete(_path(spark, f"{root}/{path}"), True)
                removed += 1
    return removed
