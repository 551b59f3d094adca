import datetime as dt
import itertools
import random

import pytest
from conftest import at, event, rows_of
from pyspark.sql import functions as F

from eventlift import schema
from eventlift.operators import facts, scoring, sessions


@pytest.fixture(scope="module")
def stg_of(raw_frame):
    return lambda rows: facts.stg_events(raw_frame(rows))


def test_gap_edges(stg_of):
    def seq(seconds):
        start = at("10:00:00")
        rows = [event(time=start), event(time=start + dt.timedelta(seconds=seconds))]
        return [r["session_seq"] for r in rows_of(sessions.sessionize(stg_of(rows)), "event_timestamp")]

    assert seq(29 * 60 + 59) == [1, 1]
    assert seq(30 * 60) == [1, 2]
    assert seq(30 * 60 + 1) == [1, 2]


def by_hand(rows, gap):
    """(event_id -> (seq, start)) from a plain scan."""
    out = {}
    for user, group in itertools.groupby(sorted(rows, key=lambda r: (r["user_id"], r["event_timestamp"])), key=lambda r: r["user_id"]):
        last, seq, start = None, 0, None
        for r in group:
            now = r["event_timestamp"]
            if last is None or (now - last).total_seconds() >= gap:
                seq, start = seq + 1, now
            out[r["event_id"]], last = (seq, start), now
    return out


@pytest.mark.parametrize("gap", [600, 1800, 7200])
def test_sessionize_against_a_plain_scan(stg_of, gap):
    rng = random.Random(gap)
    rows = [
        event(user=rng.choice("aaaab"), session="x", time=at("2024-01-10 00:00:00") + dt.timedelta(seconds=rng.randrange(0, 86_400)))
        for _ in range(250)
    ]
    expected = by_hand(rows, gap)
    frame = stg_of(rows)
    found = {r.event_id: (r.session_seq, r.session_start.replace(tzinfo=dt.timezone.utc)) for r in sessions.sessionize(frame, gap_seconds=gap).collect()}
    assert found == expected
    whole = {(r.user_id, r.session_start): r.event_count for r in sessions.gap_sessions(frame, gap_seconds=gap).collect()}
    windows = {(r.user_id, r.session_start): r.event_count for r in sessions.session_window_counts(frame, gap_seconds=gap).collect()}
    assert whole == windows and sum(whole.values()) == len(rows)
    assert len(whole) == len({(r["user_id"], expected[r["event_id"]]) for r in rows})


def test_sessionize_keeps_rows_without_user_or_time(raw_frame):
    df = raw_frame([event(user=None), event(), event(time=None)])
    rows = rows_of(sessions.sessionize(df), "event_id")
    assert [r["session_seq"] for r in rows] == [None, 1, None]


def test_step_timing_by_hand(stg_of):
    rows = [
        event(kind="session_start", time="10:00:00"),
        event(kind="quiz_started", time="10:00:10"),
        event(kind="question_viewed", time="10:00:12"),
        event(kind="slider_adjusted", time="10:00:15"),
        event(kind="quiz_step_completed", time="10:00:20"),
        event(kind="question_viewed", time="10:12:20"),
        event(kind="quiz_completed", time="10:30:00"),
        event(kind="session_end", time="11:00:00"),
    ]
    out = rows_of(sessions.derive_step_timing(stg_of(rows)), "event_timestamp")
    assert [r["derived_time_on_step_ms"] for r in out] == [None, None, 2000, None, 8000, 720_000, None, None]
    assert [r["derived_total_time_ms"] for r in out] == [None] * 6 + [1_790_000, 3_590_000]


@pytest.mark.parametrize("bits", [10, 20, 28, 40])
def test_step_timing_against_a_plain_scan(stg_of, bits):
    rng = random.Random(3)
    rows = [
        event(user="u", session=rng.choice("aab"), kind=rng.choice(schema.EVENT_TYPES), time=at("08:00:00") + dt.timedelta(milliseconds=rng.choice([rng.randrange(0, 4_000_000), 5000, 5001])))
        for _ in range(300)
    ]
    expected, clocks = {}, {}
    for r in sorted(rows, key=lambda r: (r["event_timestamp"], r["event_id"])):
        step, flow = clocks.get(r["session_id"], (None, None))
        now, kind = r["event_timestamp"], r["event_type"]
        since = lambda t: None if t is None else (now - t) // dt.timedelta(milliseconds=1)
        expected[r["event_id"]] = (
            since(step) if kind in sessions.STEP_TIMED else None,
            since(flow) if kind in sessions.FLOW_TIMED else None,
        )
        if kind in sessions.STEP_ANCHORS:
            step = now
        if kind in sessions.FLOW_ANCHORS:
            flow = now
        clocks[r["session_id"]] = (step, flow)
    out = sessions.derive_step_timing(stg_of(rows), range_bits=bits).collect()
    assert {r.event_id: (r.derived_time_on_step_ms, r.derived_total_time_ms) for r in out} == expected


def test_one_hot_session_is_spread_over_tasks(spark):
    """A session with a third of all rows within one minute: no task holds much more of the join than another."""
    kinds = F.element_at(F.array(*[F.lit(k) for k in schema.EVENT_TYPES]), (F.col("id") % len(schema.EVENT_TYPES) + 1).cast("int"))
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("session_id"),
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 1000).alias("event_timestamp"),
        F.col("id").cast("string").alias("event_id"),
        kinds.alias("event_type"),
    )
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = sorted(r["n"] for r in sessions.derive_step_timing(rows).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 4 and sizes[-1] <= 1.2 * sizes[0]


def test_events_without_session_or_time_get_no_timing(stg_of, spark):
    rows = [event(session="s", kind="quiz_started"), event(session="s", kind="question_viewed", time="10:00:05")]
    df = stg_of(rows)
    odd = df.withColumn("session_id", F.lit(None).cast("string")).unionByName(df.withColumn("event_timestamp", F.lit(None).cast("timestamp")))
    out = sessions.derive_step_timing(df.unionByName(odd)).collect()
    assert len(out) == 6 and sorted(r.derived_time_on_step_ms or 0 for r in out) == [0] * 5 + [5000]
    assert sessions.derive_step_timing(df.limit(0)).count() == 0


def test_device_classes(spark):
    agents = {
        "Android 10 Mobile": "mobile",
        "Android tab": "tablet",
        "Mozilla (iPad; CPU OS 17)": "tablet",
        "Mozilla (X11; Linux)": "desktop",
        "Opera Mini": "mobile",
        "Kindle Silk": "tablet",
        None: "unknown",
    }
    df = spark.createDataFrame([(a,) for a in agents], "ua string")
    found = {r.ua: r.d for r in df.select("ua", sessions.device_from_user_agent(F.col("ua")).alias("d")).collect()}
    assert found == agents


def test_quality_sessions(stg_of):
    rows = [event(session="short")]
    rows += [event(session="good", time=t) for t in ("10:00:00", "10:05:00")]
    rows += [event(session="long", time=t) for t in ("2024-01-10 00:00:00", "2024-01-11 00:00:01")]
    fact = facts.fact_events(stg_of(rows))
    assert [r["session_id"] for r in rows_of(sessions.quality_sessions(fact, 2, 24))] == ["good"]
    assert sessions.quality_sessions(fact).count() == 2


# -- answers and scores ------------------------------------------------------


def test_answers_take_the_last_value(stg_of):
    slider = lambda q, v, t: event(kind="slider_adjusted", time=t, properties={"question_id": q, "slider_value": float(v)})
    option = lambda q, o, t: event(kind="option_selected", time=t, properties={"question_id": q, "option_id": o})
    rows = [
        slider(1, 3, "10:00:02"),
        slider(1, 40, "10:00:01"),
        slider(4, 0, "10:00:03"),
        option(2, "ml", "10:00:01"),
        option(2, "realtime", "10:00:04"),
        option(3, "sql", "10:00:05"),
        option(3, "cloud", "10:00:06"),
        option(3, "bogus", "10:00:07"),
        event(session="s2"),
        event(session="s3", kind="quiz_step_completed", properties={"step_number": 3, "selected_options": ["python"]}),
        event(session="s3", kind="option_selected", properties={"question_id": 3, "option_id": "sql"}),
    ]
    one, two, three = rows_of(scoring.session_answers(stg_of(rows)), "session_id")
    assert one == {"session_id": "s1", "team_size": 3.0, "use_case": "realtime", "features": ["cloud", "sql"], "budget": 0.0}
    assert two == {"session_id": "s2", "team_size": 10.0, "use_case": "", "features": [], "budget": 100.0}
    assert three["features"] == ["python"]


def test_options_are_last_writer_wins(stg_of):
    def toggles(session, *steps):
        kinds = {"+": "option_selected", "-": "option_deselected"}
        return [
            event(session=session, kind=kinds[s[0]], time=f"10:00:{i:02d}", properties={"question_id": 3, "option_id": s[1:]})
            for i, s in enumerate(steps)
        ]

    rows = toggles("s1", "+sql", "-sql", "+sql", "+cloud", "-cloud", "-python") + toggles("s2", "+sql", "-sql") + toggles("s3", "+governance", "+unknown")
    random.Random(1).shuffle(rows)
    got = {r.session_id: r.features for r in scoring.session_answers(stg_of(rows)).collect()}
    assert got == {"s1": ["sql"], "s2": [], "s3": ["governance"]}


def score(spark, team=10, use_case="", features=(), budget=100):
    df = spark.createDataFrame([("s", float(team), use_case, list(features), float(budget))], "session_id string, team_size double, use_case string, features array<string>, budget double")
    return scoring.recommendation_scores(df).first()


def test_scores(spark):
    base = score(spark)
    assert (base.score_metabase, base.score_airflow, base.score_kafka) == (75, 70, 50)
    assert (base.recommendation_id, base.match_score) == ("metabase", 38)  # 37.5 rounds up
    assert score(spark, team=5).score_duckdb == 80 and score(spark, team=6).score_duckdb == 50
    assert score(spark, team=25).score_airflow == 70 and score(spark, team=26).score_kafka == 70
    assert score(spark, budget=50).score_duckdb == 80 and score(spark, budget=51).score_duckdb == 50
    assert score(spark, budget=300).score_snowflake == 75 and score(spark, budget=299).score_snowflake == 50
    assert score(spark, budget=0).score_duckdb == 50  # zero counts as the default budget
    assert score(spark, team=0).score_metabase == 75  # and as the default team size
    assert score(spark, features=["sql", "sql"]).score_duckdb == 90
    assert score(spark, features=["governance"]).score_metabase == 75


def test_ties_take_the_first_tool(spark):
    # large team, high budget, python: databricks 25+20+15 = snowflake 30+25, +5 apart; cloud keeps it
    tied = score(spark, team=50, use_case="engineering", features=["sql"], budget=100)
    assert tied.score_databricks == tied.score_snowflake == 100
    assert tied.recommendation_id == "databricks"


def test_score_is_capped(spark):
    high = score(spark, team=50, use_case="analytics", features=["cloud", "sql", "sql", "sql", "sql"], budget=400)
    assert high.score_snowflake > 200 and high.match_score == 99
