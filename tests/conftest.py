from __future__ import annotations

import datetime as dt
import itertools
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from eventlift import schema  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
_ids = itertools.count()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("eventlift-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> dt.datetime:
    """UTC time on 2024-01-10 unless a date is given."""
    stamp = dt.datetime.fromisoformat(text if "-" in text else f"2024-01-10 {text}")
    return stamp.replace(tzinfo=dt.timezone.utc)


def event(user="u1", session="s1", kind="page_view", time="10:00:00", *, properties=None, context=None, **rest):
    """One raw row as a dict; ``properties`` and ``context`` hold the nested fields."""
    moment = at(time) if isinstance(time, str) else time
    row = {
        "event_id": f"e{next(_ids):05d}",
        "user_id": user,
        "session_id": session,
        "event_type": kind,
        "event_properties": {n: (properties or {}).get(n) for n in schema.PROPERTIES.names},
        "feature_name": schema.DEFAULT_FEATURE,
        "context": {n: (context or {}).get(n) for n in schema.CONTEXT.names},
        "timestamp": None if moment is None else moment.strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
        "received_at": None,
        "kafka_timestamp": moment,
        "event_timestamp": moment,
        "processed_at": moment,
        "event_date": None if moment is None else moment.date(),
        "event_hour": None if moment is None else moment.hour,
    }
    row.update(rest)
    return row


@pytest.fixture(scope="session")
def raw_frame(spark):
    return lambda rows: spark.createDataFrame(rows, schema.RAW)


def rows_of(df, *keys):
    """Collected rows as dicts, sorted by ``keys`` (all columns by default)."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    keys = keys or df.columns
    return sorted(out, key=lambda r: [(r[k] is not None, str(r[k])) for k in keys])


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
