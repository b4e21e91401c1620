"""Command line: ``python -m smelter --base-path extracts``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from smelter.plans.pipeline import run_pipeline
from smelter.plans.profiles import PROFILES
from smelter.plans.quality import GateFailed, layer_profiles, layer_summary
from smelter.schemas import EXTRACTS
from smelter.session import shared_folder
from smelter.sources.tables import Warehouse


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="smelter", description="Run the warehouse from extracts to gold, with its gate.")
    parser.add_argument("--base-path", default="datasets", help="folder with source_crm and source_erp")
    parser.add_argument("--location", help="shared folder for the tables (default: below spark.checkpoint.dir or the warehouse folder)")
    parser.add_argument("--prefix", default="", help="text before the namespace names")
    parser.add_argument("--profile", choices=sorted(PROFILES), default="production")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="day that counts as today")
    parser.add_argument("--reset", action="store_true", help="drop the three namespaces first")
    parser.add_argument("--on-error", choices=("raise", "record"), default="raise", help="what a failed table does")
    parser.add_argument("--on-reject", choices=("keep", "fail"), default="keep", help="what a table with broken rows does")
    parser.add_argument("--loaded-at", type=dt.datetime.fromisoformat, help="time stamped on silver rows")
    parser.add_argument("--lowest-cost", type=int, help="the gate's lowest good cost, instead of the profile's")
    parser.add_argument("--on-failure", choices=("empty", "keep"), default="empty", help="what a failed table holds then")
    parser.add_argument("--live-gold", action="store_true", help="gold views that follow silver, under keys that stay")
    parser.add_argument("--buckets", type=int, default=0, help="buckets by customer key of the stored fact and customer dimension")
    parser.add_argument("--suite", choices=("bronze", "silver"), help="only run the diagnostic suite on a stored layer")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("smelter").getOrCreate()
    warehouse = Warehouse(spark, args.location or f"{shared_folder(spark)}/smelter", args.prefix)
    if args.suite:
        tables = {t: warehouse.read(args.suite, t) for t in EXTRACTS}
        layer_summary(tables, args.as_of).show(50, truncate=False)
        layer_profiles(tables).show(200, truncate=False)
        return 0
    try:
        run = run_pipeline(
            warehouse, args.base_path, args.as_of, PROFILES[args.profile], args.reset,
            on_error=args.on_error, on_reject=args.on_reject, loaded_at=args.loaded_at, lowest_cost=args.lowest_cost,
            on_failure=args.on_failure, live_gold=args.live_gold, buckets=args.buckets,
        )
    except GateFailed as failure:
        print(failure, file=sys.stderr)
        return 1
    run.audit.show(truncate=False)
    run.gate.show(50, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
