import datetime as dt
import random

import numpy as np
import pytest
from conftest import SF_DIR, at, event, rows_of

from eventlift.functions import exact_percentile
from eventlift.operators import activity, engagement, facts, funnel, retention, sessions, users
from eventlift.sources import raw_events_from_table

AS_OF = "2024-02-01 00:00:00"


@pytest.fixture(scope="module")
def fact_of(raw_frame):
    return lambda rows: facts.fact_events(facts.stg_events(raw_frame(rows)))


@pytest.fixture(scope="module")
def sample_fact(spark):
    raw = raw_events_from_table(spark.read.parquet(f"{SF_DIR}/events.parquet"))
    return facts.fact_events(facts.stg_events(raw)).cache()


@pytest.fixture(scope="module")
def sample_rollup(sample_fact):
    return activity.activity_rollup(sample_fact).cache()


# -- one definition, two inputs -------------------------------------------

BOTH_INPUTS = {
    "dim_users": lambda s: users.dim_users(s, AS_OF),
    "primary_device": users.user_primary_device,
    "daily_active_users": engagement.daily_active_users,
    "feature_adoption": engagement.feature_adoption,
    "daily_funnel_users": engagement.daily_funnel_users,
    "session_engagement": engagement.session_engagement,
    "session_summary": engagement.session_summary,
    "engagement_metrics": lambda s: engagement.engagement_metrics(s, AS_OF),
    "retention_within": retention.retention_within,
    "funnel_rates": funnel.funnel_rates,
    "funnel_long": funnel.funnel_long,
    "quality_sessions": lambda s: sessions.quality_sessions(s, 2, 6),
}


@pytest.mark.parametrize("name", BOTH_INPUTS)
def test_rollup_gives_the_same_as_facts(name, sample_fact, sample_rollup):
    build = BOTH_INPUTS[name]
    from_fact, from_rollup = rows_of(build(sample_fact)), rows_of(build(sample_rollup))
    assert len(from_fact) == len(from_rollup) > 0
    for a, b in zip(from_fact, from_rollup):
        for key in a:
            if isinstance(a[key], float) and b[key] is not None:
                assert a[key] == pytest.approx(b[key], rel=1e-12), key
            else:
                assert a[key] == b[key], key


def test_kpis_equal_the_join_of_their_parts(sample_fact):
    kpi = {r["event_date"]: r for r in rows_of(engagement.engagement_metrics(sample_fact, AS_OF))}
    parts = {}
    for part in (
        engagement.daily_active_users(sample_fact),
        engagement.feature_adoption(sample_fact),
        engagement.daily_funnel_users(sample_fact),
        engagement.session_summary(sample_fact),
    ):
        for row in rows_of(part):
            parts.setdefault(row["event_date"], {}).update(row)
    assert kpi.keys() == parts.keys()
    for day, row in kpi.items():
        part = parts[day]
        assert row["dau"] == part["dau"]
        assert row["feature_users"] == part.get("feature_users", 0)
        assert row["total_interactions"] == part.get("total_interactions", 0)
        assert row["quiz_starts"] == part["started_users"]
        assert row["result_shares"] == part["shared_users"]
        for name in ("avg_events_per_session", "avg_progress_pct", "median_session_duration_seconds", "share_rate_pct"):
            assert row[name] == pytest.approx(part[name] or 0, rel=1e-12)


# -- users -----------------------------------------------------------------


def test_mode_ties_take_the_smallest_and_ignore_nulls(fact_of):
    def device(name):
        return {"device_type": name, "timezone": None}

    rows = [event(context=device(d)) for d in ("b", "a", "b", "a", None, None, None)]
    row = users.dim_users(fact_of(rows), AS_OF).first()
    assert row.primary_device == "a" and row.primary_timezone is None
    assert users.user_primary_device(fact_of(rows)).first().asDict() == {"user_id": "u1", "primary_device": "a", "device_events": 2}


def test_user_dimension_by_hand(fact_of):
    rows = [
        event(session="s1", kind="quiz_started", time="2024-01-10 23:59:00"),
        event(session="s1", kind="quiz_completed", time="2024-01-11 00:01:00", properties={"total_time_ms": 1000, "match_score": 80.0}),
        event(session="s2", kind="session_end", time="2024-01-11 08:00:00", properties={"total_time_ms": 2000}),
        event(session="s2", kind="zzz", time="2024-01-11 08:01:00"),
    ]
    row = users.dim_users(fact_of(rows), AS_OF).first()
    assert len(row) == 24
    assert (row.user_tenure_days, row.days_since_first_seen, row.days_since_last_seen) == (1, 22, 21)
    assert (row.total_sessions, row.active_days, row.total_events) == (2, 2, 4)
    assert (row.avg_events_per_session, row.sessions_per_active_day) == (2.0, 1.0)
    assert (row.quizzes_started, row.quizzes_completed, row.quiz_completion_rate) == (1, 1, 100.0)
    assert row.user_segment == "engaged"
    assert (row.avg_match_score, row.avg_completion_time_ms) == (80.0, 1500.0)


def test_segments_partition_users(fact_of):
    def quiz(user, started, completed, shared):
        kinds = ["page_view"] + ["quiz_started"] * started + ["quiz_completed"] * completed + ["result_shared"] * shared
        return [event(user=user, session=user, kind=k) for k in kinds]

    rows = quiz("p", 3, 3, 1) + quiz("e", 3, 3, 0) + quiz("x", 1, 0, 2) + quiz("v", 0, 0, 0)
    dims = users.dim_users(fact_of(rows), AS_OF)
    found = {r.user_id: r.user_segment for r in dims.collect()}
    assert found == {"p": "power_user", "e": "engaged", "x": "explorer", "v": "visitor"}
    assert sum(r.users for r in users.user_segments(dims).collect()) == 4
    assert dims.where("user_id = 'v'").first().quiz_completion_rate == 0.0


# -- engagement ------------------------------------------------------------


def test_day_without_adopters_has_null_rate(fact_of):
    rows = [event(kind="page_view"), event(kind="result_viewed", user="u2", session="s2")]
    row = engagement.engagement_metrics(fact_of(rows), AS_OF).first()
    assert row.dau == 2 and row.feature_users == 0 and row.feature_adoption_rate_pct is None
    assert row.total_interactions == 0 and row.quiz_completion_rate_pct == 0.0
    assert row.median_session_duration_seconds == 0.0 and row.avg_match_score == 0.0


def test_session_over_midnight_gives_two_rows(fact_of):
    rows = [event(time="2024-01-10 23:59:59"), event(time="2024-01-11 00:00:01")]
    assert engagement.session_engagement(fact_of(rows)).count() == 2


def test_distinct_types_count_undeclared_ones(fact_of):
    rows = [event(kind=k) for k in ("page_view", "page_view", "quiz_started", "zzz", "zzz", "yyy")]
    for source in (fact_of(rows), activity.activity_rollup(fact_of(rows))):
        assert engagement.session_engagement(source).first().unique_event_types == 4


def test_engagement_window_bounds(fact_of):
    rows = [event(time=f"2024-01-{d:02d} 12:00:00") for d in (1, 2, 31)] + [event(time="2024-02-01 00:00:00")]
    days = [str(r.event_date) for r in engagement.engagement_window(fact_of(rows), AS_OF, 30).collect()]
    assert sorted(days) == ["2024-01-02", "2024-01-31"]


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_exact_percentile(spark, fraction):
    rng = random.Random(7)
    groups = {
        "one": [5],
        "two": [1, 2],
        "hot": [70_000] * 300 + [1, 2, 3],
        "wide": [rng.randrange(-(10**9), 10**9) for _ in range(501)],
        "near": [65_535, 65_536, 65_536, 131_072],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("none", None), ("one", None)]
    df = spark.createDataFrame(rows, "g string, v long")
    found = {r.g: r.p for r in exact_percentile(df, ["g"], "v", fraction, "p").collect()}
    assert found.keys() == groups.keys()
    for g, values in groups.items():
        assert found[g] == pytest.approx(float(np.percentile(values, fraction * 100)), rel=1e-12)
    whole = exact_percentile(df, [], "v", fraction, "p").first().p
    everything = [v for values in groups.values() for v in values]
    assert whole == pytest.approx(float(np.percentile(everything, fraction * 100)), rel=1e-12)


# -- retention -------------------------------------------------------------


def test_retention_rows_appear_for_empty_groups(fact_of):
    dims = users.dim_users(fact_of([event()]), AS_OF)
    rows = {r.user_group: r for r in retention.retention_comparison(dims).collect()}
    assert rows["completers"].user_count == 0 and rows["completers"].return_rate_pct is None
    assert rows["non_completers"].user_count == 1 and rows["non_completers"].return_rate_pct == 0.0
    assert retention.retention_lift(dims).first().retention_lift_pct is None
    nothing = retention.retention_comparison(dims.where("false")).collect()
    assert [r.user_count for r in nothing] == [0, 0]


def test_retention_lift(fact_of):
    def visits(user, days, kind="page_view"):
        return [event(user=user, session=f"{user}{d}", kind=kind, time=f"2024-01-{d:02d} 10:00:00") for d in days]

    rows = visits("a", [1, 2], "quiz_completed") + visits("b", [1], "quiz_completed")
    rows += visits("c", [1, 9]) + visits("d", [1]) + visits("e", [1]) + visits("f", [1])
    dims = users.dim_users(fact_of(rows), AS_OF)
    lift = retention.retention_lift(dims).first()
    assert (lift.completer_return_rate_pct, lift.non_completer_return_rate_pct) == (50.0, 25.0)
    assert lift.retention_lift_pct == 100.0
    within = {r.user_group: r.returned_users for r in retention.retention_within(fact_of(rows), 7).collect()}
    assert within == {"completers": 1, "non_completers": 0}
    assert {r.user_group: r.returned_users for r in retention.retention_within(fact_of(rows), 8).collect()}["non_completers"] == 1


# -- funnel ----------------------------------------------------------------


def test_funnel_flags_and_rates(fact_of):
    def step(n):
        return {"step_number": n, "total_steps": 4}

    rows = [
        event(user="a", session="a", kind="quiz_started", properties={"total_steps": 4}),
        event(user="a", session="a", kind="question_viewed", properties=step(1)),
        event(user="a", session="a", kind="question_viewed", properties=step(2)),
        event(user="a", session="a", kind="quiz_completed", properties={"total_time_ms": 45_678}),
        event(user="b", session="b", kind="page_view"),
        event(user="b", session="b2", kind="question_viewed", properties=step(3)),
    ]
    progress = rows_of(funnel.funnel_progress(fact_of(rows)), "session_id")
    flags = [c for c in progress[0] if c.startswith("reached_")]
    assert len(flags) == 7 and all(r[c] in (0, 1) for r in progress for c in flags)
    a, b, b2 = progress
    assert [a[c] for c in flags] == [1, 1, 1, 1, 1, 0, 0]
    assert [b[c] for c in flags] == [1, 0, 0, 0, 0, 0, 0]
    assert [b2[c] for c in flags] == [0, 0, 0, 1, 0, 0, 0]
    day = funnel.funnel_analysis(fact_of(rows), AS_OF).first()
    assert len(day) == 9 + 7 + 6 + 4 + 3 + 1
    assert (day.total_users, day.step1_feature_view, day.step4_mid_quiz) == (2, 2, 2)
    assert (day.step2_pct, day.conv_3_to_4, day.dropoff_1_to_2) == (50.0, 200.0, 50.0)
    assert day.conv_6_to_7 is None and day.share_after_completion_rate == 0.0
    assert day.avg_completion_time_seconds == 45.7
    long = funnel.funnel_long(fact_of(rows)).collect()
    assert [r.step_order for r in long] == list(range(1, 8))
    assert [r.users_reached for r in long] == [2, 1, 1, 2, 1, 0, 0]
    assert [r.dropoff_band for r in long] == [None, "red", "green", "green", "red", "red", None]


def test_empty_input_gives_empty_or_zero_results(fact_of, spark):
    nothing = fact_of([event()]).where("false")
    assert engagement.engagement_metrics(nothing, AS_OF).count() == 0
    assert users.dim_users(nothing, AS_OF).count() == 0
    assert [r.users_reached for r in funnel.funnel_long(nothing).collect()] == [0] * 7


# -- scans -----------------------------------------------------------------


def test_heavy_user_is_spread_before_it_meets(sample_fact):
    """The grouping below the user is by (user, kind, value), never by the user alone."""
    plan = users.dim_users(sample_fact, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in plan and "kind" in plan
    assert "collect_" not in plan and "Expand" not in plan


def test_as_of_accepts_datetime(fact_of):
    a = users.dim_users(fact_of([event()]), dt.datetime(2024, 2, 1)).first()
    assert a.days_since_last_seen == 22 and a.updated_at == at("2024-02-01 00:00:00").replace(tzinfo=None)
