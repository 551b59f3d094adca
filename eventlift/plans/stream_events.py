"""spark-submit entry point: messages to raw lake and windowed metrics.

    spark-submit --packages <kafka connector> eventlift/plans/stream_events.py \
        --output <lake> --checkpoints <shared folder> --servers host:9092
"""

from __future__ import annotations

import argparse

from eventlift.operators.ingest import parse_events
from eventlift.operators.quality import FUTURE_TOLERANCE
from eventlift.plans.session import build_session, checkpoint_root
from eventlift.sources.messages import DEFAULT_TOPIC, stream_messages
from eventlift.streaming.fanout import outputs, start_fanout
from eventlift.streaming.job import await_all, start_all, start_dead_letters, valid_only
from eventlift.streaming.sinks import DEFAULT_TRIGGER


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source", choices=["kafka", "files"], default="kafka")
    parser.add_argument("--servers", default="localhost:9092")
    parser.add_argument("--topic", default=DEFAULT_TOPIC)
    parser.add_argument("--path", help="message folder for --source files")
    parser.add_argument(
        "--max-per-trigger",
        type=int,
        help="offsets or files per micro-batch; no limit unless given",
    )
    parser.add_argument("--allow-data-loss", action="store_true", help="go on where the topic has dropped messages")
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoints")
    parser.add_argument(
        "--trigger", default=DEFAULT_TRIGGER, help="interval, or 'once' to drain and stop"
    )
    parser.add_argument("--dedup", action="store_true")
    parser.add_argument("--approx", action="store_true")
    parser.add_argument("--valid-only", action="store_true", help="keep only events that pass validation")
    parser.add_argument("--dead-letters", action="store_true", help="also write the events that do not")
    parser.add_argument("--activity", action="store_true", help="also write active users and events per minute")
    parser.add_argument("--files-per-hour", type=int, default=8, help="tasks that write an hour of the raw lake")
    parser.add_argument(
        "--future-tolerance", default=FUTURE_TOLERANCE, help="how far a clock may be ahead of the broker's"
    )
    parser.add_argument(
        "--fan-out", action="store_true", help="one query that reads once and writes raw, rejected, rollup and receipts"
    )
    args = parser.parse_args(argv)

    spark = build_session("eventlift-stream")
    checkpoints = checkpoint_root(spark, args.checkpoints)
    trigger = None if args.trigger == "once" else args.trigger
    messages = stream_messages(
        spark,
        args.source,
        servers=args.servers,
        topic=args.topic,
        path=args.path,
        max_per_trigger=args.max_per_trigger,
        fail_on_data_loss=not args.allow_data_loss,
    )
    events = parse_events(messages)
    if args.fan_out:
        sinks = outputs(args.files_per_hour, args.future_tolerance)
        await_all(spark, [start_fanout(events, args.output, f"{checkpoints}/fanout", trigger=trigger, sinks=sinks)])
        return
    queries = start_all(
        valid_only(events) if args.valid_only else events,
        args.output,
        checkpoints,
        trigger=trigger,
        realtime_trigger=None if trigger is None else "1 minute",
        dedup=args.dedup,
        approx=args.approx,
        files_per_hour=args.files_per_hour,
        future_tolerance=args.future_tolerance,
        activity=args.activity,
    )
    if args.dead_letters:
        queries.append(start_dead_letters(events, args.output, checkpoints, trigger=trigger))
    await_all(spark, queries)


if __name__ == "__main__":
    main()
