import json

import pytest
from conftest import event, plan_of, rows_of
from pyspark.sql import functions as F

from eventlift import schema
from eventlift.operators import ingest
from eventlift.sources import decode_envelope, encode_envelope

UUID1 = "550e8400-e29b-41d4-a716-446655440000"
UUID2 = "660e8400-e29b-41d4-a716-446655440001"

EXAMPLE = {
    "event_id": UUID1,
    "user_id": "anon_abc123",
    "session_id": UUID2,
    "event_type": "slider_adjusted",
    "event_properties": {"question_id": 5, "slider_value": 80, "previous_value": 50, "time_on_step_ms": 3500},
    "feature_name": "product_configurator",
    "context": {"page_url": "https://example.com/c", "device_type": "desktop", "timezone": "America/New_York"},
    "timestamp": "2024-01-15T10:30:00Z",
}


@pytest.fixture(scope="module")
def parse(spark):
    def run(*bodies):
        rows = [(None, b if isinstance(b, str) else json.dumps(b)) for b in bodies]
        messages = spark.createDataFrame(rows, "key string, value string").select(
            "key", F.col("value").cast("binary").alias("value"), F.lit("2024-01-15 10:30:01").cast("timestamp").alias("timestamp")
        )
        return ingest.parse_events(messages)

    return run


def test_parse_example_event(parse):
    df = parse(EXAMPLE)
    assert df.schema.names == schema.RAW.names
    row = df.first()
    assert row.event_properties.slider_value == 80.0
    assert row.context.device_type == "desktop"
    assert (str(row.event_date), row.event_hour) == ("2024-01-15", 10)
    assert row.processed_at is not None


def test_parse_is_permissive(parse):
    broken_field = {**EXAMPLE, "event_properties": {"step_number": "oops", "slider_value": 5}}
    nested = {**EXAMPLE, "event_properties": {"extra": {"a": {"b": 1}}}}
    bad_time = {**EXAMPLE, "timestamp": "nope"}
    garbage, field, extra, time = parse("not json", broken_field, nested, bad_time).collect()
    assert garbage.event_id is None and garbage.kafka_timestamp is not None
    assert field.event_properties.step_number is None and field.event_properties.slider_value == 5.0
    assert extra.event_properties.extra == {"a": '{"b":1}'}
    assert time.event_timestamp is None and time.event_date is None and time.event_id == UUID1


def test_envelope_round_trip(spark, raw_frame):
    raw = raw_frame([event(user="u7", received_at="2024-01-10T10:00:05Z", properties={"slider_value": 3.5})])
    message = encode_envelope(raw)
    assert message.schema == schema.ENVELOPE or message.columns == schema.ENVELOPE.names
    assert message.first().key == "u7"
    body = json.loads(decode_envelope(message).first().json_value)
    assert body["received_at"] == "2024-01-10T10:00:05.000000Z"
    back = ingest.parse_events(message).first()
    assert back.event_properties.slider_value == 3.5 and back.event_timestamp == raw.first().event_timestamp


def test_encode_stamps_missing_receive_time(raw_frame):
    moment = F.lit("2024-02-01 00:00:00").cast("timestamp")
    body = json.loads(decode_envelope(encode_envelope(raw_frame([event()]), moment)).first().json_value)
    assert body["received_at"] == "2024-02-01T00:00:00.000000Z"


def reasons(raw_frame, *rows, **options):
    options.setdefault("uuid_ids", False)
    df = ingest.validate_events(raw_frame(list(rows)), **options)
    return {r.event_id: r.reject_reasons for r in df.collect()}


def test_validation_rules(raw_frame):
    cases = {
        "good": (event(), []),
        "null_user": (event(user=None), ["user_id:missing"]),
        "blank_user": (event(user="   "), ["user_id:blank"]),
        "no_session": (event(session=None), ["session_id:missing"]),
        "no_type": (event(kind=None), ["event_type:missing"]),
        "odd_type": (event(kind="unknown_type"), ["event_type:unknown"]),
        "odd_device": (event(context={"device_type": "phone"}), ["device_type:unknown"]),
        "bad_time": (event(timestamp="nope"), ["timestamp:invalid"]),
        "no_time": (event(timestamp=None), ["timestamp:invalid"]),
        "budget": (event(properties={"slider_value": 250.0}), ["slider_value:range"]),
        "edges": (event(properties={"slider_value": 100.0, "previous_value": 0.0, "step_number": 1}), []),
        "step0": (event(properties={"step_number": 0}), ["step_number:range"]),
        "score": (event(properties={"match_score": 100.5}), ["match_score:range"]),
        "negative": (event(properties={"time_on_step_ms": -1}), ["time_on_step_ms:range"]),
        "screen": (event(context={"screen_width": -1}), ["screen_width:range"]),
        "many": (event(user="", kind="x", properties={"total_steps": 0}), ["user_id:blank", "event_type:unknown", "total_steps:range"]),
    }
    found = reasons(raw_frame, *[{**row, "event_id": name} for name, (row, _) in cases.items()])
    assert found == {name: expected for name, (_, expected) in cases.items()}


def test_validation_trims_and_checks_uuids(raw_frame):
    rows = [
        {**event(user="  u1 "), "event_id": UUID1, "session_id": UUID2},
        {**event(), "event_id": "42", "session_id": UUID2},
    ]
    df = ingest.validate_events(raw_frame(rows))
    first, second = rows_of(df, "event_id")[::-1] if df.first().event_id == "42" else rows_of(df, "event_id")
    by_id = {r["event_id"]: r for r in (first, second)}
    assert by_id[UUID1]["user_id"] == "u1" and by_id[UUID1]["reject_reasons"] == []
    assert by_id["42"]["reject_reasons"] == ["event_id:format"]


def test_own_range_rules(raw_frame):
    wide = [("event_properties.slider_value", 0, 500)]
    row = {**event(properties={"slider_value": 250.0}), "event_id": "b"}
    assert reasons(raw_frame, row, ranges=wide) == {"b": []}


def test_reasons_are_counted_by_code(raw_frame, spark, tmp_path):
    rows = [event(user=None, kind="nope"), event(kind="nope"), event(), event(event_id=None)]
    judged = ingest.validate_events(raw_frame(rows), uuid_ids=False)
    want = {"user_id:missing": 1, "event_type:unknown": 2, "event_id:missing": 1}
    assert {r.reason: r.rejected_events for r in ingest.reject_reasons(judged).collect()} == want
    assert "SortAggregate" not in plan_of(ingest.reject_reasons(judged))
    judged.write.parquet(str(tmp_path / "judged"))  # the names stay with the column
    assert {r.reason: r.rejected_events for r in ingest.reject_reasons(spark.read.parquet(str(tmp_path / "judged"))).collect()} == want


def test_accepted_plus_rejected_is_total(raw_frame):
    validated = ingest.validate_events(
        raw_frame([event(), event(user=" "), event(kind="x"), event()]), uuid_ids=False
    )
    totals = ingest.ingest_totals(validated).first()
    assert (totals.total_events, totals.accepted_events, totals.rejected_events) == (4, 2, 2)
    assert ingest.accepted_events(validated).count() == 2
    assert ingest.rejected_events(validated).count() == 2
    counts = {r.reason: r.rejected_events for r in ingest.reject_reasons(validated).collect()}
    assert counts == {"user_id:blank": 1, "event_type:unknown": 1}


def test_defaults(raw_frame):
    bare = event(event_id=None, feature_name=None, timestamp=None, event_properties=None, context=None)
    kept = event(feature_name="other", context={"device_type": "tablet"}, properties={"extra": {"a": "b"}})
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    df = ingest.apply_defaults(raw_frame([bare, kept]), now)
    filled, same = df.collect()
    assert len(filled.event_id) == 36 and filled.feature_name == schema.DEFAULT_FEATURE
    assert filled.timestamp == "2024-02-01T00:00:00.000000Z"
    assert filled.context.device_type == "unknown" and filled.event_properties.extra == {}
    assert same.feature_name == "other" and same.context.device_type == "tablet"
    assert same.event_properties.extra == {"a": "b"}
    assert ingest.validate_events(df).first().reject_reasons == ["session_id:format"]


def test_user_agent_fill(spark, raw_frame):
    df = raw_frame([event(context={"user_agent": "own"}), event()]).withColumn("header_user_agent", F.lit("hdr"))
    assert [r.user_agent for r in ingest.enrich_user_agent(df).select("context.user_agent").collect()] == ["own", "hdr"]


def test_batch_receipt(raw_frame):
    rows = [{**event(), "event_id": f"a{i}"} for i in range(3)] + [{**event(user=" "), "event_id": "a9"}]
    rows += [{**event(kind="x"), "event_id": "b0"}]
    rows += [{**event(), "event_id": f"c{i}"} for i in range(5)]
    df = ingest.validate_events(raw_frame(rows), uuid_ids=False).withColumn("batch_id", F.substring("event_id", 1, 1))
    a, b, c = rows_of(ingest.batch_receipt(df, max_events=4), "batch_id")
    assert a["success"] and a["event_ids"] == ["a0", "a1", "a2"] and a["errors"] == ["a9: user_id:blank"]
    assert (a["total_events"], a["accepted_events"], a["rejected_events"]) == (4, 3, 1)
    assert not b["success"] and b["event_ids"] == [] and b["rejected_events"] == 1
    assert not c["success"] and c["event_ids"] == [] and c["rejected_events"] == 5
    assert c["errors"] == ["batch: more than 4 events"]


def test_explode_batches(spark):
    requests = spark.createDataFrame(
        [("b1", "agent", [{"event_id": "1", "user_id": "u"}, {"event_id": "2", "user_id": "v"}])],
        "batch_id string, header_user_agent string, events array<struct<event_id string, user_id string>>",
    )
    assert rows_of(ingest.explode_batches(requests), "event_id")[1] == {
        "batch_id": "b1",
        "header_user_agent": "agent",
        "batch_refused": None,
        "event_id": "2",
        "user_id": "v",
    }


@pytest.fixture(scope="module")
def requests(spark):
    """Requests: good and bad events, empty, null, a null entry, three events."""
    good = lambda i: {n: None for n in schema.EVENT.names} | {"event_id": f"e{i}", "user_id": "u", "session_id": "s", "event_type": "page_view", "timestamp": "2024-01-10T10:00:00Z", "context": {n: None for n in schema.CONTEXT.names}}
    bad = lambda i: good(i) | {"event_type": "nope", "user_id": " \u00a0\u2003"}
    kind = f"batch_id long, header_user_agent string, events array<{schema.EVENT.simpleString()}>"
    rows = [(1, "ua", [good(2), bad(3), good(1)]), (2, "ua", []), (3, "ua", None), (4, "ua", [None, good(4)]), (5, "ua", [bad(5)])]
    return spark.createDataFrame(rows, kind)


def test_request_receipts(requests):
    found = {r.batch_id: r for r in ingest.request_receipts(requests, uuid_ids=False).collect()}
    assert found[1][1:] == (True, None, 3, 2, 1, ["e1", "e2"], ["e3: user_id:blank, event_type:unknown"])
    for i in (2, 3):
        assert found[i][1:] == (False, "batch:empty", 0, 0, 0, [], ["batch:empty"])
    assert found[4].accepted_events == 1 and found[4].errors == ["?: user_id:missing, session_id:missing, event_type:missing, timestamp:invalid, event_id:missing"]
    assert (found[5].success, found[5].rejected_events) == (False, 1)
    few = {r.batch_id: r for r in ingest.request_receipts(requests, 2, uuid_ids=False).collect()}
    assert few[1][1:] == (False, "batch:large", 3, 0, 3, [], ["batch:large"]) and few[4] == found[4]
    unlimited = {r.batch_id: r for r in ingest.request_receipts(requests, None, uuid_ids=False).collect()}
    assert unlimited == found
    plan = plan_of(ingest.request_receipts(requests))
    assert "Exchange" not in plan and "Generate" not in plan
    assert ingest.request_receipts(requests.limit(0)).count() == 0


@pytest.mark.parametrize("most", [2, None, 1000])
def test_receipts_and_totals_agree(requests, most):
    receipts = ingest.request_receipts(requests, most, uuid_ids=False).agg(*[F.sum(c) for c in ("total_events", "accepted_events", "rejected_events")]).first()
    rows = ingest.validate_events(ingest.explode_batches(requests, most), uuid_ids=False)
    assert tuple(ingest.ingest_totals(rows).first()) == tuple(receipts)
    accepted = {r.event_id for r in ingest.accepted_events(rows).collect()}
    assert accepted == ({"e1", "e2", "e4"} if most != 2 else {"e4"})
    assert {r.batch_id for r in ingest.rejected_events(rows).collect()} == {1, 2, 3, 4, 5}
    assert [r.reject_reasons for r in rows.where("batch_id = 2").collect()] == [["batch:empty"]]


def test_flat_receipts_without_a_limit(raw_frame):
    df = raw_frame([event() for _ in range(20)]).withColumn("batch_id", F.lit(1))
    rows = ingest.validate_events(df, uuid_ids=False)
    assert ingest.batch_receipt(rows, max_events=5).first().accepted_events == 0
    assert ingest.batch_receipt(rows, max_events=None).first().accepted_events == 20


def test_received_stamp_is_one_value(raw_frame):
    stamped = ingest.stamp_received(raw_frame([event(), event()]))
    assert stamped.select("received_at").distinct().count() == 1
