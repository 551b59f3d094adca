from conftest import at, event, plan_of, rows_of

from eventlift import schema
from eventlift.functions import round_n
from eventlift.operators import facts, quality


def test_bot_filter_is_case_sensitive(raw_frame):
    agents = ["Googlebot/2.1", "BOT", None, "Mozilla"]
    df = raw_frame([event(context={"user_agent": a}) for a in agents])
    assert [r.user_agent for r in quality.filter_bots(df).select("context.user_agent").collect()] == ["BOT", None, "Mozilla"]


def test_dedup_keeps_earliest_and_is_idempotent(raw_frame):
    rows = [
        event(event_id="a", processed_at=at("10:00:09")),
        event(event_id="a", processed_at=at("10:00:03")),
        event(event_id="a", processed_at=at("10:00:05")),
        event(event_id="b"),
        event(event_id=None),
        event(event_id=None),
    ]
    once = quality.dedup_events(raw_frame(rows))
    kept = once.where("event_id = 'a'").collect()
    assert len(kept) == 1 and kept[0].processed_at.second == 3
    assert once.count() == 4
    assert quality.dedup_events(once).count() == 4
    plan = plan_of(once)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedup_does_not_depend_on_the_filter(raw_frame):
    rows = [event(event_id=f"e{i % 40}", user=f"u{i}", processed_at=at(f"10:{59 - i // 2:02d}:{i % 2:02d}")) for i in range(100)]
    df = raw_frame(rows)
    want = {}
    for r in rows:
        if r["event_id"] not in want or r["processed_at"] < want[r["event_id"]]["processed_at"]:
            want[r["event_id"]] = r
    for words in (1, 3, quality.REPEAT_WORDS):
        got = {r.event_id: r.user_id for r in quality.dedup_events(df, words=words).collect()}
        assert got == {k: r["user_id"] for k, r in want.items()}
        assert quality.repeated_keys(df, "event_id", words).count() <= words
    assert quality.dedup_events(df.limit(0)).count() == 0


def test_rows_that_do_not_repeat_are_not_shuffled(raw_frame, spark, tmp_path):
    rows = [event(event_id=f"e{i}") for i in range(500)] + [event(event_id="e7")]
    raw_frame(rows).write.parquet(str(tmp_path / "raw"))
    once = quality.dedup_events(facts.staged_rows(spark.read.parquet(str(tmp_path / "raw"))))
    assert once.count() == 500
    plan = plan_of(once).lower()
    below = plan[plan.index("window [row_number") :]
    assert below.index("exchange hashpartitioning(event_id") < below.index("contains(")  # bots go below the exchange
    # the only rows sorted are those that share a bit with a repeated id
    assert plan.count("sort [event_id") == 2 and plan.count("exchange hashpartitioning(event_id") == 1


def test_dq_checks(raw_frame):
    rows = [
        event(event_id="a"),
        event(event_id="a"),
        event(event_id="b", user=None),
        event(event_id="c", kind="nope"),
    ]
    df = raw_frame(rows).select("*", "context.device_type")
    found = {r.check: r.failing_rows for r in quality.dq_checks(df).collect()}
    assert found["unique_event_id"] == 2
    assert found["not_null_user_id"] == 1
    assert found["accepted_values_event_type"] == 1
    assert found["not_null_event_id"] == 0


def test_staging_filters_and_flattens(raw_frame):
    bot = {"user_agent": "Xbot"}
    rows = [event(), event(user=None), event(session=None), event(kind=None), event(event_id=None), event(context=bot)]
    staged = facts.stg_events(raw_frame(rows))
    assert staged.count() == 1
    assert facts.stg_events(raw_frame(rows), include_bot_traffic=True).count() == 2
    assert len(staged.columns) == 33
    assert {"user_timezone", "user_locale"} <= set(staged.columns)
    assert not {"extra", "user_agent", "viewport_width"} & set(staged.columns)


def test_categories_cover_all_types(raw_frame):
    df = facts.fact_events(facts.stg_events(raw_frame([event(kind=t) for t in [*schema.EVENT_TYPES, "zzz"]])))
    found = {r.event_type: r.event_category for r in df.collect()}
    expected = {t: c for c, types in schema.CATEGORY_TYPES.items() for t in types} | {"zzz": "other"}
    assert found == expected and len(schema.EVENT_TYPES) == 17


def test_fact_measures_and_zero_denominators(raw_frame):
    def one(properties=None, context=None):
        return facts.fact_events(facts.stg_events(raw_frame([event(properties=properties, context=context)]))).first()

    row = one({"step_number": 1, "total_steps": 3, "slider_value": 10.0, "previous_value": 60.0, "time_on_step_ms": 3456}, {"screen_width": 390, "screen_height": 844})
    assert row.flow_progress_pct == 33.3
    assert row.slider_change_magnitude == 50.0
    assert row.time_on_step_seconds == 3.46
    assert row.screen_aspect_ratio == 0.46
    empty = one({"step_number": 1, "total_steps": 0, "slider_value": 1.0, "time_on_step_ms": 0}, {"screen_width": 10, "screen_height": 0})
    assert empty.flow_progress_pct is None and empty.slider_change_magnitude is None
    assert empty.time_on_step_seconds is None and empty.screen_aspect_ratio is None
    assert len(facts.fact_events(facts.stg_events(raw_frame([event()]))).columns) == 33


def test_rounding_scales_like_the_warehouse(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(23, 4000), (201, 200)], "a int, b int")
    values = [r[0] for r in df.select(round_n(F.col("a") / F.col("b") * 100, 2)).collect()]
    assert values[0] == 0.57
    assert spark.range(1).select(round_n(F.lit(1.005), 2)).first()[0] == 1.0


def test_staging_reaches_the_parquet_scan(spark, raw_frame, tmp_path):
    path = str(tmp_path / "lake")
    raw_frame([event(), event(time="2024-01-11 09:00:00")]).write.partitionBy("event_date", "event_hour").parquet(path)
    lake = spark.read.schema(schema.RAW).parquet(path)
    fact = facts.fact_events(facts.stg_events(lake)).where("event_date = DATE'2024-01-11'").select("event_type", "step_number")
    plan = plan_of(fact)
    for name in ("event_id", "user_id", "session_id", "event_type"):
        assert f"IsNotNull({name})" in plan
    assert "PartitionFilters: [isnotnull(event_date" in plan
    read = plan[plan.index("ReadSchema") :]
    assert "step_number" in read and "slider_value" not in read and "page_url" not in read
    assert rows_of(fact) == [{"event_type": "page_view", "step_number": None}]
