import datetime as dt
import os
from types import SimpleNamespace

import pytest
from conftest import SF_DIR, event, plan_of, rows_of
from pyspark.sql import functions as F

from eventlift.operators import serving
from eventlift.operators.quality import dedup_events
from eventlift.plans import run_marts
from eventlift.plans.gate import Gate, QualityError
from eventlift.plans.marts import (
    REPORTS,
    TABLES,
    Variables,
    build_marts,
    load_marts,
    retention_report,
    windowed_marts,
)
from eventlift.plans.publish import Publication, StaleManifest, published, vacuum
from eventlift.plans.session import checkpoint_root
from eventlift.sources import raw_events_from_table, read_raw_lake
from eventlift.streaming.sinks import compact_raw, write_raw

AS_OF = "2024-02-01 00:00:00"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "raw")
    raw = raw_events_from_table(spark.read.parquet(f"{SF_DIR}/events.parquet")).drop("id")
    write_raw(raw, path)
    return path


@pytest.fixture(scope="module")
def marts(spark, lake, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("marts"))
    return out, build_marts(spark, read_raw_lake(spark, lake), out, as_of=AS_OF)


def test_lake_layout_and_types(spark, lake):
    days = [d for d in os.listdir(lake) if d.startswith("event_date=")]
    assert len(days) == 30
    df = read_raw_lake(spark, lake)
    assert dict(df.dtypes)["event_date"] == "date" and dict(df.dtypes)["event_hour"] == "int"
    raw = raw_events_from_table(spark.read.parquet(f"{SF_DIR}/events.parquet"))
    assert df.count() == raw.count()


def test_marts_are_written_and_consistent(spark, marts):
    out, tables = marts
    assert list(tables) == TABLES
    assert tables["fact_events"].count() == tables["activity"].agg({"events": "sum"}).first()[0]
    users = tables["dim_users"]
    assert users.agg({"total_events": "sum"}).first()[0] == tables["fact_events"].count()
    assert users.count() == users.select("user_id").distinct().count()
    assert tables["engagement_metrics"].count() == 30 == tables["funnel_analysis"].count()
    assert spark.table("stg_events").count() == tables["fact_events"].count()
    report = retention_report(tables)
    assert sum(r.user_count for r in report["comparison"].collect()) == users.count()
    assert sum(r.user_count for r in report["within_window"].collect()) == users.count()


def test_refreshing_days_reproduces_the_full_build(spark, lake, marts, tmp_path):
    _, full = marts
    out = str(tmp_path / "m")
    raw = read_raw_lake(spark, lake)
    first = raw.where("event_date < DATE'2024-01-20'")
    build_marts(spark, first, out, as_of=AS_OF)
    days = (dt.date(2024, 1, 19), dt.date(2024, 1, 31))
    again = build_marts(spark, raw, out, as_of=AS_OF, days=days)
    for name in TABLES:
        assert rows_of(again[name].select(*sorted(again[name].columns))) == rows_of(
            full[name].select(*sorted(full[name].columns))
        ), name


def test_variables(spark, lake, marts, tmp_path):
    _, full = marts
    bots = build_marts(
        spark, read_raw_lake(spark, lake), str(tmp_path / "b"), as_of=AS_OF, variables=Variables(include_bot_traffic=True, dedup=True)
    )
    raw = read_raw_lake(spark, lake).where("user_id IS NOT NULL")
    assert bots["fact_events"].count() == raw.select("event_id").distinct().count()
    recent = windowed_marts(full, AS_OF, Variables(engagement_window_days=7, min_events_per_session=2))
    days = [str(r.event_date) for r in recent["engagement_metrics"].collect()]
    assert min(days) == "2024-01-25" and len(days) == 6
    assert recent["sessions"].where("event_count < 2").count() == 0


def test_entry_point_and_compaction(spark, lake, marts, tmp_path):
    compacted, out = str(tmp_path / "compact"), str(tmp_path / "out")
    compact_raw(spark, lake, compacted)
    assert rows_of(read_raw_lake(spark, compacted).select("event_id", "processed_at")) == rows_of(
        read_raw_lake(spark, lake).select("event_id", "processed_at")
    )
    run_marts.main(["--raw", compacted, "--output", out, "--as-of", AS_OF])
    _, full = marts
    assert rows_of(load_marts(spark, out)["dim_users"]) == rows_of(full["dim_users"])


def test_checkpoint_folder_comes_from_the_cluster():
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))

    shared = session(**{"spark.checkpoint.dir": "/shared/cp/"})
    assert checkpoint_root(shared, "/given") == "/given"
    assert checkpoint_root(shared, None) == "/shared/cp/eventlift"
    with pytest.raises(ValueError):
        checkpoint_root(session(), None)


# -- plans -------------------------------------------------------------------


def test_marts_read_the_rollup_once_and_never_cross_join(spark, marts):
    from eventlift.operators.engagement import engagement_metrics
    from eventlift.operators.funnel import funnel_analysis
    from eventlift.operators.users import dim_users

    _, tables = marts
    activity = tables["activity"]
    # The KPI table reads once for its chain and twice, narrowly, for the exact median.
    for df, scans in ((dim_users(activity, AS_OF), 1), (funnel_analysis(activity, AS_OF), 1), (engagement_metrics(activity, AS_OF), 3)):
        plan = plan_of(df)
        assert plan.count("FileScan") - plan.count("SubqueryAdaptiveBroadcast") == scans
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_day_filter_prunes_partitions(spark, lake):
    plan = plan_of(dedup_events(read_raw_lake(spark, lake).where("event_date = DATE'2024-01-05'")).select("event_id", "processed_at"))
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "page_url" not in plan


# -- serving -----------------------------------------------------------------


def test_serving_tables(spark, marts):
    _, tables = marts
    metrics = tables["engagement_metrics"]
    assert [str(r.event_date) for r in serving.latest_metrics(metrics, 2).collect()] == ["2024-01-30", "2024-01-29"]
    card = serving.kpi_cards(metrics).first()
    assert card.adoption_delta_pct == pytest.approx(card.adoption_rate_pct - 30)
    assert [len(serving.metrics_last_n_days(metrics, n).collect()) for n in (7, 14, 30, None)] == [7, 14, 30, 30]
    trend = [r.event_date for r in serving.engagement_trends(metrics).collect()]
    assert trend == sorted(trend)
    hours = serving.hourly_pattern(tables["fact_events"]).collect()
    assert [r.hour_of_day for r in hours] == list(range(24))
    assert sum(r.event_count for r in hours) == tables["fact_events"].count()
    devices = serving.device_distribution(tables["fact_events"]).collect()
    assert sum(r.share_pct for r in devices) == pytest.approx(100, abs=0.05)


def test_undeclared_device_counts_as_unknown(raw_frame):
    from eventlift.operators.facts import fact_events, stg_events

    devices = ["desktop", "fridge", None, "unknown"]
    rows = [event(session=f"s{i}", context={"device_type": d}) for i, d in enumerate(devices)]
    found = {r.device_type: r.sessions for r in serving.device_distribution(fact_events(stg_events(raw_frame(rows)))).collect()}
    assert found == {"desktop": 1, "unknown": 3}


def test_latency_percentile_reads_its_input_once(spark, lake):
    from eventlift.operators.health import ingest_latency

    latency = ingest_latency(read_raw_lake(spark, lake))
    latency.collect()
    plan = plan_of(latency).partition("== Initial Plan")[0]
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1


# -- publishing ---------------------------------------------------------------


def test_a_failed_run_leaves_the_published_marts(spark, lake, tmp_path, monkeypatch):
    from eventlift.plans import marts as plan

    out = str(tmp_path / "m")
    build_marts(spark, read_raw_lake(spark, lake).where("event_date < DATE'2024-01-10'"), out, as_of=AS_OF)
    before = {n: rows_of(d.select(*sorted(d.columns))) for n, d in load_marts(spark, out).items()}

    def broken(*args):
        raise OSError("disk")

    monkeypatch.setattr(plan, "funnel_analysis", broken)
    with pytest.raises(OSError):
        build_marts(spark, read_raw_lake(spark, lake), out, as_of=AS_OF)
    assert {n: rows_of(d.select(*sorted(d.columns))) for n, d in load_marts(spark, out).items()} == before
    assert vacuum(spark, out) == 4  # fact, activity, users and metrics of the failed run
    assert {n: rows_of(d.select(*sorted(d.columns))) for n, d in load_marts(spark, out).items()} == before


def test_days_without_rows_go_and_others_stay(spark, lake, tmp_path):
    out = str(tmp_path / "m")
    raw = read_raw_lake(spark, lake).where("event_date < DATE'2024-01-06'")
    build_marts(spark, raw, out, as_of=AS_OF)
    days = (dt.date(2024, 1, 3), dt.date(2024, 1, 4))
    again = build_marts(spark, raw.where("event_date <> DATE'2024-01-03'"), out, as_of=AS_OF, days=days)
    assert [str(r[0]) for r in again["engagement_metrics"].select("event_date").orderBy("event_date").collect()] == ["2024-01-01", "2024-01-02", "2024-01-04", "2024-01-05"]
    assert vacuum(spark, out) > 0
    assert load_marts(spark, out)["fact_events"].where("event_date = DATE'2024-01-04'").count() > 0
    assert "PartitionFilters: [isnotnull(event_date" in plan_of(load_marts(spark, out)["fact_events"].where("event_date = DATE'2024-01-04'"))


def test_two_runs_at_once_do_not_overwrite_each_other(spark, tmp_path):
    first, second = Publication(spark, str(tmp_path)), Publication(spark, str(tmp_path))
    for run, n in ((first, 3), (second, 5)):
        assert run.write("t", spark.range(n)).count() == n
    first.publish()
    with pytest.raises(StaleManifest):
        second.publish()
    assert published(spark, str(tmp_path))["t"].count() == 3
    empty = Publication(spark, str(tmp_path))
    assert empty.write("t", spark.range(0).withColumn("event_date", F.lit(dt.date(2024, 1, 1))), by_day=True).count() == 0


def test_the_gate_decides_about_publication(spark, lake, tmp_path):
    out = str(tmp_path / "m")
    raw = read_raw_lake(spark, lake).where("event_date < DATE'2024-01-04'")
    good = build_marts(spark, raw, out, as_of=AS_OF, gate=Gate())
    rows = good["fact_events"].count()
    odd = raw.withColumn("event_type", F.when(F.hash("event_id") % 2 == 0, F.lit("nope")).otherwise(F.col("event_type")))
    for gate, source, check in ((Gate(), odd, "event_type:unknown"), (Gate(allowed={}), raw, "event_type:unknown"), (Gate(least_rows=10**6), raw, "rows:few")):
        with pytest.raises(QualityError) as error:
            build_marts(spark, source, out, as_of=AS_OF, gate=gate)
        assert list(error.value.broken) == [check]
    assert load_marts(spark, out)["fact_events"].count() == rows
    assert Gate(allowed={"event_type:unknown": 1}, least_rows=rows)


def test_job_settings_from_the_command_line(spark, lake, tmp_path):
    out = str(tmp_path / "m")
    common = ["--raw", lake, "--output", out, "--as-of", AS_OF, "--reports"]
    run_marts.main([*common, "--dedup", "--gather-facts", "--gate", "--allow", "event_type:unknown=0.5", "--vacuum"])
    plain = {n: rows_of(d) for n, d in published(spark, out).items() if n in REPORTS}
    assert set(plain) == set(REPORTS) and all(plain.values())
    changed = ["--include-bot-traffic", "--retention-window-days", "0", "--min-events-per-session", "6", "--engagement-window-days", "5"]
    run_marts.main([*common, "--dedup", *changed])
    other = published(spark, out)
    assert len(rows_of(other["recent_engagement"])) < len(plain["recent_engagement"])
    for table in ("retention_within", "quality_sessions", "event_breakdown"):
        assert rows_of(other[table]) != plain[table], table
    with pytest.raises(QualityError):
        run_marts.main([*common, "--gate", "--least-rows", "100000000"])


@pytest.mark.parametrize(
    ("flags", "setting", "value"),
    [
        (["--include-bot-traffic"], "include_bot_traffic", True),
        (["--dedup"], "dedup", True),
        (["--gather-facts"], "gather_facts", True),
        (["--min-events-per-session", "3"], "min_events_per_session", 3),
        (["--max-session-duration-hours", "1.5"], "max_session_duration_hours", 1.5),
        (["--retention-window-days", "14"], "retention_window_days", 14),
        (["--engagement-window-days", "60"], "engagement_window_days", 60),
    ],
)
def test_every_flag_reaches_its_setting(spark, lake, monkeypatch, flags, setting, value):
    seen = {}
    monkeypatch.setattr(run_marts, "build_marts", lambda *args, **settings: seen.update(settings))
    run_marts.main(["--raw", lake, "--output", "/nowhere", *flags])
    assert seen["variables"] == Variables(**{setting: value}) != Variables()
