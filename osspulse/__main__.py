"""`spark-submit` / `python -m osspulse`: one daily run."""

from __future__ import annotations

import argparse
from datetime import UTC, date, datetime

from osspulse.pipeline import run_day
from osspulse.session import build_session
from osspulse.sources import read_download_log


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="osspulse", description=__doc__)
    parser.add_argument("--landing", required=True, help="root of the landed API responses")
    parser.add_argument("--projects", required=True, help="CSV of tracked repositories and packages")
    parser.add_argument("--download-log", help="download events, Parquet partitioned by dt")
    parser.add_argument("--target-date", type=date.fromisoformat, help="download day, default yesterday")
    parser.add_argument("--interval-end", type=datetime.fromisoformat, help="end of the scheduled interval")
    parser.add_argument("--backfill", action="store_true", help="also load days before the newest one")
    parser.add_argument("--full-refresh", action="store_true", help="rebuild the incremental facts from all raw rows")
    parser.add_argument("--landed-since", type=date.fromisoformat, help="first landing day to read")
    parser.add_argument("--pages", action="store_true", help="landed files hold one response page each, not JSON lines")
    parser.add_argument("--report-only", action="store_true", help="failed checks do not stop the run")
    options = parser.parse_args(arguments)

    spark = build_session()
    log = read_download_log(spark, options.download_log) if options.download_log else None
    counts = run_day(
        spark,
        options.landing,
        options.projects,
        datetime.now(UTC),
        log,
        target_date=options.target_date,
        interval_end=options.interval_end,
        backfill=options.backfill,
        full_refresh=options.full_refresh,
        landed_since=options.landed_since,
        multi_line=options.pages,
        enforce=not options.report_only,
    )
    counts.show(truncate=False)


if __name__ == "__main__":
    main()
