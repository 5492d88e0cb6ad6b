"""Command line of the pipeline: ``spark-submit outlay/__main__.py --root … --as-of … <step>``.

Steps: ``run`` (one interval), ``backfill``, ``files`` (snapshot files), and the
single steps ``load-window``, ``load-snapshot``, ``build``, ``test``, ``publish``.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import date, datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from outlay.config import Config  # noqa: E402
from outlay.operators.quality import gate  # noqa: E402
from outlay.plans import interval  # noqa: E402
from outlay.session import build_session  # noqa: E402
from outlay.sources.landing import ingest_records, landing_path  # noqa: E402
from outlay.sources.marts import TableFolder  # noqa: E402
from outlay.sources.raw import LoadReport, load_snapshot, load_window  # noqa: E402


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="outlay", description=__doc__)
    top.add_argument("--root", required=True, help="folder of landing files, raw tables, marts and products")
    top.add_argument("--as-of", required=True, type=date.fromisoformat)
    steps = top.add_subparsers(dest="step", required=True)
    now = datetime.now(timezone.utc).isoformat(timespec="seconds")

    def step(name: str, *dates: str, texts: tuple[str, ...] = ()) -> argparse.ArgumentParser:
        sub = steps.add_parser(name)
        sub.add_argument("--loaded-at", default=now)
        for option in dates:
            sub.add_argument(option, required=True, type=date.fromisoformat)
        for option in texts:
            sub.add_argument(option, required=True)
        return sub

    run = step("run")
    run.add_argument("--interval-end", type=date.fromisoformat)
    run.add_argument("--not-latest", action="store_true")
    step("backfill").add_argument("--interval-ends", required=True, nargs="+", type=date.fromisoformat)
    step("files", texts=("--agreements", "--amendments"))
    step("load-window", "--start", "--end")
    for name in ("load-snapshot", "build", "test", "publish"):
        step(name)
    return top


def show(reports: list[LoadReport]) -> None:
    for report in reports:
        print(f"{report.table}: removed={report.removed} inserted={report.inserted} undated={report.undated}")
        if report.warning:
            print(f"warning: {report.warning}", file=sys.stderr)


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session("outlay")
    config = Config(args.as_of, args.root)
    marts = TableFolder(spark, config.marts)
    if args.step == "run":
        show(interval.run_interval(spark, config, args.loaded_at, args.interval_end, not args.not_latest))
    elif args.step == "backfill":
        show(interval.backfill(spark, config, args.interval_ends, args.loaded_at))
    elif args.step == "files":
        interval.run_files(spark, config, args.agreements, args.amendments, args.loaded_at)
    elif args.step == "load-window":
        landed = ingest_records(spark, landing_path(config.landing_agreements, args.end))
        show([load_window(landed, config.raw_agreements, args.start, args.end, args.loaded_at)])
    elif args.step == "load-snapshot":
        landed = ingest_records(spark, landing_path(config.landing_amendments, config.as_of))
        show([load_snapshot(landed, config.raw_amendments, args.loaded_at)])
    elif args.step == "build":
        interval.build_marts(spark, config).make_current()
    elif args.step == "test":
        gate(interval.check_marts(marts))
    elif args.step == "publish":
        interval.publish(marts, config.products, args.loaded_at)


if __name__ == "__main__":
    main()
