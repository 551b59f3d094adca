import datetime as dt
import os
import random
import time

import pytest
from conftest import SF_DIR, at, event, rows_of

from eventlift import schema
from eventlift.operators import ingest, sessions
from eventlift.operators.quality import dedup_stream
from eventlift.plans import stream_events
from eventlift.sources import (
    encode_envelope,
    raw_events_from_table,
    read_event_files,
    read_message_files,
    read_raw_lake,
    stream_event_files,
    stream_messages,
    stream_raw_lake,
)
from eventlift.streaming import aggregates, job, sinks

SENTINEL = dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)


def put(df, path, name, age):
    """Write ``df`` as one file ``name`` under ``path`` with a modification time."""
    temporary = f"{path}-{name}"
    df.coalesce(1).write.parquet(temporary)
    (part,) = [f for f in os.listdir(temporary) if f.startswith("part-")]
    os.makedirs(path, exist_ok=True)
    target = os.path.join(path, f"{name}.parquet")
    os.link(os.path.join(temporary, part), target)
    stamp = time.time() - age
    os.utime(target, (stamp, stamp))


@pytest.fixture(scope="module")
def events_rows():
    rng = random.Random(11)
    rows = []
    for _ in range(400):
        user = rng.choice(["hot"] * 5 + ["a", "b", "c", None])
        rows.append(
            event(
                user=user,
                session=f"{user}-{rng.randrange(3)}",
                kind=rng.choice(schema.EVENT_TYPES),
                time=at("2024-01-10 00:00:00") + dt.timedelta(seconds=rng.randrange(0, 6 * 3600)),
                properties={"time_on_step_ms": rng.choice([None, 100, 250]), "recommendation_id": rng.choice([None, "kafka", "duckdb"])},
                context={"device_type": rng.choice(["desktop", "mobile"])},
            )
        )
    return rows


@pytest.fixture(scope="module")
def folder(spark, raw_frame, events_rows, tmp_path_factory):
    """Data in a first file, a far-future event in a second: closes all windows."""
    path = str(tmp_path_factory.mktemp("stream") / "in")
    put(raw_frame(events_rows), path, "data", age=100)
    put(raw_frame([event(kind="quiz_started", session="end", user="end", time=SENTINEL)]), path, "sentinel", age=10)
    return path


def run(df, name):
    query = df.writeStream.format("memory").queryName(name).outputMode("append").start()
    try:
        query.processAllAvailable()
        return df.sparkSession.table(name)
    finally:
        query.stop()


CASES = {
    "session_metrics": aggregates.session_metrics,
    "realtime_metrics": aggregates.realtime_metrics,
    "stream_funnel": aggregates.stream_funnel,
    "active_users": aggregates.active_users,
    "events_per_minute": aggregates.events_per_minute,
}


@pytest.mark.parametrize("name", CASES)
def test_stream_equals_batch(spark, raw_frame, events_rows, folder, name):
    build = CASES[name]
    got = rows_of(run(build(stream_raw_lake(spark, folder, 1)), f"t_{name}"))
    expected = rows_of(build(raw_frame(events_rows)))
    assert len(expected) > 0 and got == expected


@pytest.mark.parametrize("build", [aggregates.realtime_metrics, aggregates.stream_funnel])
def test_approximate_mode_counts_events_exactly(spark, raw_frame, events_rows, folder, build):
    exact, rough = rows_of(build(raw_frame(events_rows))), rows_of(build(raw_frame(events_rows), approx=True))
    key = "event_count" if "event_count" in exact[0] else "total_events"
    assert [r[key] for r in exact] == [r[key] for r in rough]
    streamed = run(build(stream_raw_lake(spark, folder, 1), approx=True), f"t_{build.__name__}_approx")
    assert streamed.count() == len(exact)


def test_session_window_on_a_stream_is_strict(spark, raw_frame, events_rows, folder):
    stream = stream_raw_lake(spark, folder, 1).where("user_id IS NOT NULL").withWatermark("event_timestamp", "1 hour")
    got = rows_of(run(sessions.session_window_counts(stream), "t_sessions"))
    batch = raw_frame(events_rows).where("user_id IS NOT NULL")
    assert got == rows_of(sessions.session_window_counts(batch)) and len(got) > 4


def test_dedup_before_a_window_counts_an_id_once(spark, raw_frame, events_rows, tmp_path):
    path = str(tmp_path / "in")
    put(raw_frame(events_rows + events_rows[:150]), path, "data", age=100)
    put(raw_frame([event(time=SENTINEL)]), path, "sentinel", age=10)
    stream = dedup_stream(stream_raw_lake(spark, path, 1), "1 hour")
    got = rows_of(run(aggregates.events_per_minute(stream), "t_dedup"))
    assert got == rows_of(aggregates.events_per_minute(raw_frame(events_rows)))


def test_late_events_stay_in_raw_but_leave_windows(spark, raw_frame, tmp_path):
    path = str(tmp_path / "in")
    put(raw_frame([event(time="10:00:00")]), path, "a", age=300)
    put(raw_frame([event(time="15:00:00")]), path, "b", age=200)
    # A late row is judged by the watermark one micro-batch before its own.
    put(raw_frame([event(time="15:10:00")]), path, "c", age=150)
    put(raw_frame([event(time="10:00:30")]), path, "late", age=100)
    put(raw_frame([event(time=SENTINEL)]), path, "sentinel", age=10)
    stream = stream_raw_lake(spark, path, 1)
    counted = run(aggregates.events_per_minute(stream), "t_late")
    assert sorted(r.event_count for r in counted.collect()) == [1, 1, 1]
    lake, checkpoint = str(tmp_path / "lake"), str(tmp_path / "cp")
    sinks.write_raw_stream(stream, lake, checkpoint, trigger=None).awaitTermination(120)
    assert read_raw_lake(spark, lake).count() == 5


def test_job_from_messages_to_tables(spark, tmp_path):
    """The entry point drains a message folder into the lake and the metric tables."""
    raw = raw_events_from_table(spark.read.parquet(f"{SF_DIR}/events.parquet"))
    messages, out = str(tmp_path / "messages"), str(tmp_path / "out")
    sinks.write_messages(encode_envelope(raw), messages)
    assert read_message_files(spark, messages).count() == raw.count()
    arguments = ["--source", "files", "--path", messages, "--output", out, "--checkpoints", str(tmp_path / "cp")]
    arguments += ["--trigger", "once", "--dead-letters"]
    stream_events.main(arguments)
    lake = read_raw_lake(spark, f"{out}/raw")
    assert lake.count() == raw.count()
    assert lake.schema.names == schema.RAW.names
    assert rows_of(lake.select("event_id", "event_timestamp", "event_hour").distinct()) == rows_of(
        raw.select("event_id", "event_timestamp", "event_hour").distinct()
    )
    hours = spark.read.parquet(f"{out}/session_metrics")
    full = aggregates.session_metrics(raw)
    assert 0 < hours.count() <= full.count()
    columns = full.columns[1:]
    assert hours.select(columns).subtract(full.select(columns)).count() == 0
    assert spark.read.parquet(f"{out}/rejected").count() == raw.count()  # ids of the sample are no UUIDs
    # A second run continues from the checkpoints and adds nothing.
    stream_events.main(arguments)
    assert read_raw_lake(spark, f"{out}/raw").count() == raw.count()


def test_message_files_keep_order_within_a_user(spark, tmp_path):
    raw = raw_events_from_table(spark.read.parquet(f"{SF_DIR}/events.parquet"))
    path = str(tmp_path / "m")
    sinks.write_messages(encode_envelope(raw), path)
    from pyspark.sql import functions as F

    per_file = read_message_files(spark, path).groupBy(F.input_file_name().alias("f")).agg(
        F.min(F.struct("key", "timestamp")).alias("low"), F.max(F.struct("key", "timestamp")).alias("high")
    )
    bounds = sorted((tuple(r.low), tuple(r.high)) for r in per_file.where("low.key IS NOT NULL").collect())
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))


def test_json_days(spark, raw_frame, tmp_path):
    path = str(tmp_path / "json")
    rows = raw_frame([event(time="2024-01-10 10:00:00", properties={"slider_value": 2.5}), event(time="2024-01-11 10:00:00")])
    sinks.write_json_days(rows.select(*schema.EVENT.names), path)
    assert sorted(d for d in os.listdir(path) if d.startswith("day=")) == ["day=2024-01-10", "day=2024-01-11"]
    back = read_event_files(spark, path)
    assert back.count() == 2 and back.where("event_properties.slider_value = 2.5").count() == 1
    assert set(back.columns) >= set(schema.EVENT.names)
    parsed = ingest.with_ingest_metadata(stream_event_files(spark, path, 1))
    assert run(parsed.select("event_id", "event_timestamp"), "t_json").count() == 2


def test_source_arguments(spark):
    with pytest.raises(ValueError):
        stream_messages(spark, "files")
    with pytest.raises(ValueError):
        stream_messages(spark, "carrier-pigeon")
    # No broker connector is installed here; the reader must at least ask for it.
    with pytest.raises(Exception, match="(?i)kafka"):
        stream_messages(spark, "kafka", servers="localhost:9092", topic="t")


def test_await_all_raises_and_stops_the_rest(spark, raw_frame, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "in")
    put(raw_frame([event(), event()]), path, "a", age=100)
    stream = stream_raw_lake(spark, path)
    good = sinks.start_append(stream.select("event_id"), str(tmp_path / "g"), str(tmp_path / "gc"), trigger="1 second")
    bad_frame = stream.select(F.raise_error(F.lit("boom")).cast("string").alias("x"))
    bad = sinks.start_append(bad_frame, str(tmp_path / "b"), str(tmp_path / "bc"), trigger="1 second")
    with pytest.raises(Exception):
        job.await_all(spark, [good, bad])
    assert not good.isActive and not bad.isActive
