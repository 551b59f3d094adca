"""spark-submit entry point: raw lake to marts.

    spark-submit eventlift/plans/run_marts.py --raw <lake>/raw --output <marts>
"""

from __future__ import annotations

import argparse
import datetime as dt

from eventlift.plans.gate import Gate
from eventlift.plans.marts import Variables, build_marts, build_reports
from eventlift.plans.publish import vacuum
from eventlift.plans.session import build_session
from eventlift.sources.lake import read_raw_lake


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--as-of", help="moment of the run, now by default")
    parser.add_argument("--include-bot-traffic", action="store_true")
    parser.add_argument("--dedup", action="store_true")
    parser.add_argument("--gather-facts", action="store_true", help="shuffle the fact table into even files per day")
    defaults = Variables()
    parser.add_argument("--min-events-per-session", type=int, default=defaults.min_events_per_session)
    parser.add_argument("--max-session-duration-hours", type=float, default=defaults.max_session_duration_hours)
    parser.add_argument("--retention-window-days", type=int, default=defaults.retention_window_days)
    parser.add_argument("--engagement-window-days", type=int, default=defaults.engagement_window_days)
    parser.add_argument("--reports", action="store_true", help="also write the report and serving tables")
    parser.add_argument("--gate", action="store_true", help="publish only what passes the quality checks")
    parser.add_argument(
        "--allow",
        action="append",
        default=[],
        metavar="CHECK=SHARE",
        help="share of rows that may fail a check of the gate; may be repeated",
    )
    parser.add_argument("--least-rows", type=int, default=0, help="fewer fact rows than this break the gate")
    parser.add_argument("--vacuum", action="store_true", help="delete unpublished versions afterwards")
    parser.add_argument("--from-day", type=dt.date.fromisoformat)
    parser.add_argument("--to-day", type=dt.date.fromisoformat)
    args = parser.parse_args(argv)

    spark = build_session("eventlift-marts")
    if (args.from_day is None) != (args.to_day is None):
        parser.error("--from-day and --to-day go together")
    days = (args.from_day, args.to_day) if args.from_day else None
    variables = Variables(
        include_bot_traffic=args.include_bot_traffic,
        dedup=args.dedup,
        min_events_per_session=args.min_events_per_session,
        max_session_duration_hours=args.max_session_duration_hours,
        retention_window_days=args.retention_window_days,
        engagement_window_days=args.engagement_window_days,
        gather_facts=args.gather_facts,
    )
    gate = None
    if args.gate:
        given = {check: float(share) for check, _, share in (a.rpartition("=") for a in args.allow)}
        gate = Gate(allowed={**Gate().allowed, **given}, least_rows=args.least_rows)
    raw = read_raw_lake(spark, args.raw)
    build_marts(spark, raw, args.output, as_of=args.as_of, variables=variables, days=days, gate=gate)
    if args.reports:
        build_reports(spark, args.output, as_of=args.as_of, variables=variables)
    if args.vacuum:
        vacuum(spark, args.output)


if __name__ == "__main__":
    main()
