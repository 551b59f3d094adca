"""Messages are encoded once, after they are dealt; waiting for queries minds no others."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventlift.sources import encode_envelope, read_message_files
from eventlift.streaming import job, sinks
from conftest import event, plan_of


def test_encoded_after_dealing(spark, raw_frame, tmp_path):
    rows = [event(user=f"u{i % 7}" if i % 9 else None, time=f"10:{i:02d}:00", received_at=f"2024-01-10T10:{(i * 7) % 60:02d}:00Z") for i in range(60)]
    events = raw_frame(rows)
    plan = plan_of(sinks.dealt_messages(events))
    assert plan.index("AS value#") < plan.index("rangepartitioning")  # the plan prints its last step first
    sinks.write_messages(encode_envelope(events), str(tmp_path / "one"))
    sinks.write_event_messages(events, str(tmp_path / "other"))
    one, other = (sorted((r.key or "", bytes(r.value), r.timestamp) for r in read_message_files(spark, str(tmp_path / d)).collect()) for d in ("one", "other"))
    assert one == other and len(one) == 60
    for own in read_message_files(spark, str(tmp_path / "other")).withColumn("file", F.input_file_name()).groupBy("file").agg(F.collect_list(F.struct("key", "timestamp")).alias("rows")).collect():
        placed = [(r.key or "", r.timestamp) for r in own.rows]
        assert placed == sorted(placed)


def test_a_failure_of_another_query_is_not_raised(spark, raw_frame, tmp_path):
    source = str(tmp_path / "in")
    encode_envelope(raw_frame([event()])).write.parquet(source)
    stream = lambda: spark.readStream.schema("key string, value binary, timestamp timestamp").parquet(source)
    broken = stream().withColumn("x", F.raise_error(F.lit("killed"))).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "b")).trigger(availableNow=True)
    with pytest.raises(Exception, match="killed"):
        job.await_all(spark, [broken.start()])
    other = broken.start()
    while other.isActive:
        pass
    job.await_all(spark, [sinks.start_append(stream(), str(tmp_path / "out"), str(tmp_path / "c"), trigger=None)])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
