"""Command line for the weekly tasks (``python -m ledgerlens ...``).

Each command is one task of the weekly schedule and can be rerun on its
own; paths are any Spark paths (shared file system or object store).

  land     landed reports of a run date -> bronze partitions
  week     bronze gate, silver, gold, warehouse load, gold gate, summary
  backfill landed reports -> one bronze run date per past year, all domains
  prices   landed price pages -> last-Friday prices (full or incremental)
  init     create missing warehouse tables
  calendar insert the days of [start, end] that dim_date lacks
  views    create or replace the catalog views of the warehouse tables
  prune    delete versions of the lake and warehouse replaced long ago
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import uuid

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens.config import CALENDAR_END, CALENDAR_START, TICKER_PATTERN
from ledgerlens.operators import quality
from ledgerlens.session import ensure_checkpoint_dir
from ledgerlens.sources import lake


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("ledgerlens").getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ledgerlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    land = sub.add_parser("land")
    land.add_argument("--landing", required=True)
    land.add_argument("--lake", required=True)
    land.add_argument("--run-date", required=True)
    land.add_argument("--sections", default="overview,financials,valuation",
                      help="comma list; dividend and management are flattened generically")
    week = sub.add_parser("week")
    week.add_argument("--lake", required=True)
    week.add_argument("--warehouse", required=True)
    week.add_argument("--run-date", required=True)
    week.add_argument("--no-enforce", action="store_true")
    week.add_argument("--min-rows", type=int, default=50, help="bronze gate: fewest financial rows")
    week.add_argument("--max-rows", type=int, default=500, help="bronze gate: most financial rows, 0 for no bound")
    week.add_argument("--ticker-pattern", default=TICKER_PATTERN)
    back = sub.add_parser("backfill")
    back.add_argument("--landing", required=True)
    back.add_argument("--lake", required=True)
    back.add_argument("--run-date", required=True)
    back.add_argument("--years", type=int, default=2)
    old = sub.add_parser("prune")
    old.add_argument("--lake", required=True)
    old.add_argument("--warehouse", required=True)
    old.add_argument("--hours", type=float, default=168.0, help="age of the replacement that is left alone")
    prices = sub.add_parser("prices")
    prices.add_argument("--pages", required=True, help="landed price pages (JSON lines: ticker, value)")
    prices.add_argument("--lake", required=True)
    prices.add_argument("--run-date", required=True)
    views = sub.add_parser("views")
    views.add_argument("--warehouse", required=True)
    views.add_argument("--database", default="ledgerlens")
    init = sub.add_parser("init")
    init.add_argument("--warehouse", required=True)
    cal = sub.add_parser("calendar")
    cal.add_argument("--warehouse", required=True)
    cal.add_argument("--start", default=CALENDAR_START)
    cal.add_argument("--end", default=CALENDAR_END)
    args = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")

    spark = _session()
    if args.cmd == "land":
        from ledgerlens.plans.weekly_run import bronze_from_landing

        sections = tuple(x for x in args.sections.split(",") if x)
        skipped = bronze_from_landing(spark, args.landing, args.lake, args.run_date, sections=sections)
        print(json.dumps({"skipped": skipped}))
    elif args.cmd == "week":
        from ledgerlens.plans.weekly_run import run_week

        suite = quality.bronze_suite(args.min_rows, args.max_rows or None, args.ticker_pattern)
        res = run_week(
            spark, args.lake, args.warehouse, args.run_date, enforce_gates=not args.no_enforce, bronze_suite=suite
        )
        print(json.dumps(res.summary.asDict()))
    elif args.cmd == "backfill":
        from ledgerlens.plans.weekly_run import backfill_from_landing

        status = backfill_from_landing(spark, args.landing, args.lake, args.run_date, args.years)
        print(json.dumps(status))
        return 0 if all(x == "ok" for x in status.values()) else 1
    elif args.cmd == "prune":
        from ledgerlens.plans import dimension, warehouse
        from ledgerlens.schemas import WAREHOUSE_TABLES

        age = dt.timedelta(hours=args.hours)
        n = sum(
            lake.prune_domain(spark, args.lake, layer, domain, age)
            for layer in ("bronze", "silver", "quarantine") for domain in lake.folder_names(spark, f"{args.lake}/{layer}")
        )
        n += lake.prune_domain(spark, args.warehouse, warehouse.LAYER, warehouse.FACT, age)
        n += sum(
            (dimension.prune if name == warehouse.COMPANY else lake.prune)(spark, warehouse.table_path(args.warehouse, name), age)
            for name in WAREHOUSE_TABLES if name != warehouse.FACT
        )
        print(json.dumps({"removed": n}))
    elif args.cmd == "prices":
        from ledgerlens.operators.flatten import flatten_prices
        from ledgerlens.plans.ingest import load_prices
        from ledgerlens.sources.raw import read_landed_keyed

        pages = read_landed_keyed(spark, args.pages, "ticker string, value string")
        seen = Observation(f"pages_{uuid.uuid4().hex}")
        load = load_prices(spark, flatten_prices(pages, observation=seen), args.lake, args.run_date)
        told = seen.get if load != "skipped" else {}
        print(json.dumps({"load": load, "skipped_pages": int(told.get("malformed") or 0)}))
    elif args.cmd == "views":
        from ledgerlens.plans.catalog import publish_views

        print(json.dumps({"views": publish_views(spark, args.warehouse, args.database)}))
    elif args.cmd == "init":
        from ledgerlens.plans.warehouse import ensure_warehouse

        print(json.dumps([r.asDict() for r in ensure_warehouse(spark, args.warehouse).collect()]))
    elif args.cmd == "calendar":
        from ledgerlens.plans import calendar_dim, warehouse

        bounds = spark.range(1).select(F.lit(args.start).alias("start"), F.lit(args.end).alias("end"))
        table = warehouse.write_dim_date(spark, args.warehouse, calendar_dim.calendar(bounds))
        print(json.dumps({"dim_date": table.count()}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
