"""Command line: run the audit on trip files.

    python -m cordon --yellow DIR --green DIR --zones FILE [--weather FILE] [--out ROOT]
                     [--phase all|trips|rollup|results|compact|vacuum] [--incremental]
                     [--layout keep|rebalance] [--month-salt N]

``--out`` defaults to ``<spark.checkpoint.dir>/cordon``. ``--incremental`` takes only the raw files
that no published run has taken, and adds them; several may run at once. ``--layout`` and ``--month-salt``
override how trips are clustered by month before they are written (``sources/sinks.py``). The phases
``compact`` (all current runs into one with planned file sizes) and ``vacuum`` (folders that no reader needs
any more) run only when they are named.
"""

from __future__ import annotations

import argparse

from cordon.config import DEFAULT_CONFIG
from cordon.plans import audit
from cordon.session import ensure_checkpoint_dir, get_session
from cordon.sources import raw


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="cordon")
    ap.add_argument("--yellow", required=True)
    ap.add_argument("--green", required=True)
    ap.add_argument("--zones", required=True)
    ap.add_argument("--zones-format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--weather")
    ap.add_argument("--weather-format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--out")
    ap.add_argument("--phase", default="all", choices=["all", "trips", "rollup", "results", "compact", "vacuum"])
    ap.add_argument("--incremental", action="store_true")
    ap.add_argument("--layout", choices=["keep", "rebalance"])
    ap.add_argument("--month-salt", type=int)
    return ap.parse_args(argv)


def run(spark, args: argparse.Namespace, cfg=DEFAULT_CONFIG) -> audit.AuditTables:
    root = (args.out or f"{ensure_checkpoint_dir(spark).rstrip('/')}/cordon").rstrip("/")
    tables = audit.AuditTables(root)
    zones = raw.read_zones(spark, args.zones, args.zones_format)
    weather = raw.read_weather(spark, args.weather, args.weather_format) if args.weather else None
    if args.phase in ("all", "trips"):
        audit.ingest(spark, {"yellow": args.yellow, "green": args.green}, cfg, tables, full=not args.incremental,
                     month_salt=args.month_salt, layout=args.layout)
    if args.phase == "compact":
        audit.compact(spark, tables)
    if args.phase == "vacuum":
        audit.vacuum(spark, tables)
    if args.phase == "rollup":
        audit.write_zone_daily(spark, zones, cfg, tables)
    if args.phase in ("all", "results"):
        audit.write_results(spark, tables, zones, weather, cfg)
    return tables


def main(argv: list[str] | None = None) -> None:
    spark = get_session(app_name="cordon")
    run(spark, parse(argv))
    spark.stop()


if __name__ == "__main__":
    main()
