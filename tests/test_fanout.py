import datetime as dt
import random

import pytest
from conftest import at, event, rows_of
from pyspark.sql import functions as F
from test_streaming import put, run

from eventlift import schema
from eventlift.operators.ingest import accepted_events, validate_events
from eventlift.operators.quality import future_events, present_events
from eventlift.plans import stream_events
from eventlift.sources import encode_envelope, stream_raw_lake
from eventlift.streaming import aggregates, fanout, job
from eventlift.streaming.sinks import write_messages


@pytest.fixture(scope="module")
def arrivals():
    """Two files of events: users, types, a bad one in ten, late ones in the second file."""
    rng = random.Random(4)
    files = []
    for start in ("2024-01-10 10:00:00", "2024-01-10 09:00:00"):
        rows = []
        for i in range(150):
            moment = at(start) + dt.timedelta(seconds=rng.randrange(3600))
            rows.append(
                event(
                    user=rng.choice(["hot"] * 4 + ["a", "b", "c"]),
                    session=rng.choice("xyz"),
                    kind="nope" if i % 10 == 0 else rng.choice(schema.EVENT_TYPES),
                    time=moment,
                    properties={"time_on_step_ms": rng.choice([None, 100, 250])},
                    kafka_timestamp=moment + dt.timedelta(seconds=2),
                )
            )
        files.append(rows)
    return files


@pytest.fixture(scope="module")
def source(raw_frame, arrivals, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fanout") / "in")
    for i, rows in enumerate(arrivals):
        put(raw_frame(rows), path, f"f{i}", age=100 - i * 10)
    return path


def drain(spark, source, out, sinks=None):
    query = fanout.start_fanout(stream_raw_lake(spark, source, 1), out, f"{out}-checkpoint", trigger=None, sinks=sinks, uuid_ids=False)
    query.awaitTermination()
    return query


def assert_complete(spark, raw_frame, arrivals, out):
    every = raw_frame([r for rows in arrivals for r in rows])
    good = accepted_events(validate_events(every, uuid_ids=False))
    read = lambda name: fanout.read_output(spark, out, name)
    assert sorted(r.event_id for r in read("raw").collect()) == sorted(r.event_id for r in good.collect())
    assert read("rejected").count() == 30 == read("rejected").select("event_id").distinct().count()
    assert read("receipts").agg(F.sum("total_events"), F.sum("accepted_events")).first() == (300, 270)
    minutes = read("minutes")
    for made, whole in (
        (fanout.metrics_from_minutes(minutes), aggregates.realtime_metrics(good)),
        (fanout.funnel_from_minutes(minutes), aggregates.stream_funnel(good)),
    ):
        assert rows_of(made.select(*sorted(made.columns))) == rows_of(whole.select(*sorted(made.columns)))


def test_one_read_for_all_outputs(spark, raw_frame, arrivals, source, tmp_path):
    out = str(tmp_path / "lake")
    query = drain(spark, source, out)
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in progress] == [150, 150]  # each row once, whatever the number of outputs
    assert all(len(p["sources"]) == 1 for p in progress)
    assert_complete(spark, raw_frame, arrivals, out)
    drain(spark, source, out)  # nothing new: nothing changes
    assert_complete(spark, raw_frame, arrivals, out)


@pytest.mark.parametrize("killed", ["rejected", "minutes", "receipts"])
def test_a_kill_between_outputs_leaves_no_trace(spark, raw_frame, arrivals, source, tmp_path, killed):
    out, calls = str(tmp_path / "lake"), []

    def second_fails(judged):
        calls.append(killed)
        if len(calls) == 2:
            raise OSError("killed")
        return fanout.outputs()[killed][0](judged)

    with pytest.raises(Exception, match="killed"):
        drain(spark, source, out, {**fanout.outputs(), killed: (second_fails, [])})
    # the raw rows of the second batch are written but not committed
    assert fanout.read_output(spark, out, "raw").count() == 135
    drain(spark, source, out)
    assert_complete(spark, raw_frame, arrivals, out)


def test_nothing_committed_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        fanout.read_output(spark, str(tmp_path), "raw")


def test_a_clock_in_2030_loses_no_later_event(spark, raw_frame, tmp_path):
    wild = event(kind="page_view", user="wild", time=at("2030-01-01 00:00:00"), kafka_timestamp=at("10:00:01"))
    early = [event(user=f"u{i}", time=f"10:0{i}:00", kafka_timestamp=at(f"10:0{i}:01")) for i in range(5)]
    later = [event(user=f"v{i}", time=f"10:3{i}:00", kafka_timestamp=at(f"10:3{i}:01")) for i in range(5)]
    last = [event(user=f"w{i}", time=f"11:0{i}:00", kafka_timestamp=at(f"11:0{i}:01")) for i in range(5)]
    end = event(user="end", time=at("2024-01-12 00:00:00"), kafka_timestamp=at("2024-01-12 00:00:01"))
    path = str(tmp_path / "in")
    for i, rows in enumerate(([wild, *early], later, last, [end])):
        put(raw_frame(rows), path, f"f{i}", age=100 - i * 10)
    minutes = lambda df: sorted(r.window_start for r in df.collect())
    stream = stream_raw_lake(spark, path, 1)
    assert len(minutes(run(aggregates.events_per_minute(present_events(stream)), "t_present"))) == 15
    assert len(minutes(run(aggregates.events_per_minute(stream), "t_wild"))) < 15  # without the guard
    everything = raw_frame([wild, *early, *later, *last, end, event(time=None, kafka_timestamp=None)])
    assert [r.user_id for r in future_events(everything).collect()] == ["wild"]
    assert present_events(everything).count() == 17

    out = str(tmp_path / "out")
    job.await_all(spark, job.start_all(stream, out, f"{out}-c", trigger=None, realtime_trigger=None, activity=True))
    assert spark.read.parquet(f"{out}/events_per_minute").count() == 15
    assert spark.read.parquet(f"{out}/active_users").count() > 15
    assert spark.read.parquet(f"{out}/raw").where("user_id = 'wild'").count() == 1


def test_fan_out_from_the_command_line(spark, raw_frame, tmp_path):
    rows = [event(time=f"10:00:{i:02d}") for i in range(20)] + [event(time=at("2031-01-01 00:00:00"), received_at="2024-01-10T10:00:00Z")]
    good = [r | {"event_id": f"00000000-0000-4000-8000-{i:012d}", "session_id": "00000000-0000-4000-8000-0000000000aa"} for i, r in enumerate(rows)]
    bad = [event(user=None, time="10:01:00")]
    sent = raw_frame(good + bad).withColumn("received_at", F.coalesce("received_at", F.lit("2024-01-10T10:05:00Z")))
    write_messages(encode_envelope(sent), str(tmp_path / "messages"))
    out = str(tmp_path / "lake")
    arguments = ["--source", "files", "--path", str(tmp_path / "messages"), "--output", out, "--checkpoints", str(tmp_path / "c"), "--trigger", "once", "--fan-out", "--files-per-hour", "2", "--future-tolerance", "1 day"]
    for _ in range(2):  # the second run finds nothing new
        stream_events.main(arguments)
        sizes = {name: fanout.read_output(spark, out, name).count() for name in fanout.outputs()}
        assert sizes == {"raw": 20, "rejected": 1, "future": 1, "minutes": 1, "receipts": 1}
