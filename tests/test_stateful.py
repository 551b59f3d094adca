import datetime as dt
import random

import pytest
from conftest import at, event
from test_streaming import put, run

from eventlift.operators import sessions
from eventlift.sources import stream_raw_lake
from eventlift.streaming import stateful

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKS)
    yield
    spark.conf.set(key, before)


def test_merging_runs():
    rng = random.Random(8)
    for _ in range(200):
        moments = [rng.randrange(300) for _ in range(rng.randrange(1, 40))]
        whole = stateful.merged([], [(m, m, 1) for m in moments], 10)
        assert all(b[0] - a[1] >= 10 for a, b in zip(whole, whole[1:])) and sum(s[2] for s in whole) == len(moments)
        half = stateful.merged([], [(m, m, 1) for m in moments[::2]], 10)
        assert stateful.merged(half, [(m, m, 1) for m in moments[1::2]], 10) == whole  # in any order


def test_stream_sessions_equal_batch_out_of_order(spark, raw_frame, tmp_path, rocks):
    rng = random.Random(6)
    start = at("2024-01-10 00:00:00")
    minutes = lambda m: start + dt.timedelta(minutes=m)
    # gaps of exactly 30 minutes, a microsecond less, and random ones
    rows = [event(user="edge", time=minutes(m)) for m in (0, 30, 60)]
    rows += [event(user="less", time=minutes(m) - dt.timedelta(microseconds=i)) for i, m in enumerate((10, 40, 70))]
    rows += [event(user=rng.choice(["hot", "hot", "a", "b", None]), time=start + dt.timedelta(seconds=rng.randrange(4 * 3600))) for _ in range(150)]
    rng.shuffle(rows)
    path = str(tmp_path / "in")
    for i in range(3):
        put(raw_frame(rows[i::3]), path, f"f{i}", age=100 - i * 10)
    put(raw_frame([event(user="end", time=at("2024-02-01 00:00:00"))]), path, "g", age=20)
    stream = stateful.stream_gap_sessions(stream_raw_lake(spark, path, 1), watermark="1 day")
    query = stream.writeStream.format("memory").queryName("t_gap_state").outputMode("append").start()
    try:
        query.processAllAvailable()
        got = sorted(map(tuple, spark.table("t_gap_state").collect()))
        state = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    finally:
        query.stop()
    whole = sessions.gap_sessions(raw_frame(rows), gap_seconds=1800)
    assert got == sorted(map(tuple, whole.select("user_id", "session_start", "session_end", "event_count").collect()))
    assert [g[3] for g in got if g[0] == "edge"] == [1, 1, 1] and [g[3] for g in got if g[0] == "less"] == [3]
    assert state <= 4  # the last user's session and its timer: all others are gone
