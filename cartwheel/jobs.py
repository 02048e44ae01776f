"""spark-submit entry points.

  python -m cartwheel.jobs load  --source-dir D --root R [--start S --end E | --lookback N]
                                 [--tables a,b] [--dry-run]
  python -m cartwheel.jobs daily --source-dir D --root R --run-date YYYY-MM-DD [--first-load] [--full-refresh]

``load`` is the ad-hoc/first load (Entry C): an explicit window or N days back
from today, optionally a subset of tables; an unknown table name exits with
code 2 before anything runs; ``--dry-run`` prints the plan of each load.
``source-dir`` holds the driver tables, shaped into sources by the adapter.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from cartwheel.params import Params
from cartwheel.sources.registry import LANDINGS


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cartwheel.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)
    load = sub.add_parser("load")
    load.add_argument("--source-dir", required=True)
    load.add_argument("--root", required=True)
    load.add_argument("--start", type=dt.date.fromisoformat)
    load.add_argument("--end", type=dt.date.fromisoformat)
    load.add_argument("--lookback", type=int)
    load.add_argument("--tables")
    load.add_argument("--dry-run", action="store_true")
    daily = sub.add_parser("daily")
    daily.add_argument("--source-dir", required=True)
    daily.add_argument("--root", required=True)
    daily.add_argument("--run-date", type=dt.date.fromisoformat, required=True)
    daily.add_argument("--first-load", action="store_true")
    daily.add_argument("--no-gate", action="store_true")
    daily.add_argument("--full-refresh", action="store_true")
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    tables = [t.strip() for t in args.tables.split(",") if t.strip()] if getattr(args, "tables", None) else None
    if tables:
        unknown = [t for t in tables if t not in LANDINGS]
        if unknown:
            print(f"unknown tables: {', '.join(unknown)}", file=sys.stderr)
            return 2
    if (getattr(args, "start", None) is None) != (getattr(args, "end", None) is None):
        print("--start and --end go together", file=sys.stderr)
        return 2
    from cartwheel.session import build_session
    from cartwheel.sources.adapter import raw_sources
    spark = spark or build_session()
    sources = raw_sources(spark, args.source_dir)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    if args.cmd == "load":
        from cartwheel.sources.loads import run_loads
        report = run_loads(spark, sources, f"{args.root}/raw", start=args.start, end=args.end,
                           lookback=args.lookback, tables=tables, dry_run=args.dry_run,
                           ingested_at=now)
        if args.dry_run:
            for name in report:
                print(f"-- {name}: {json.dumps(report[name])}")
                sources[name].explain()
        else:
            print(json.dumps(report, default=str))
        return 0
    from cartwheel.plans.daily import run_daily
    window = (dt.date.min, args.run_date) if args.first_load else None
    report = run_daily(spark, sources, args.root, Params(run_date=args.run_date), now,
                       gate=not args.no_gate, load_window=window, full_refresh=args.full_refresh)
    print(json.dumps({"built": report.built,
                      "failing_checks": {c.name: c.failures for c in report.checks if c.failures}}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
