"""Command line: the daily job and its parts, for a scheduler or spark-submit.

    python -m candlewick land   --pages FILES --landing DIR [--limit 1000] [--rejects DIR]
    python -m candlewick run    --landing DIR --warehouse DIR [--symbols A,B] [--strategy sliced]
                                [--incremental]
    python -m candlewick load   --landing DIR --warehouse DIR
    python -m candlewick stream --landing DIR --warehouse DIR [--archive DIR]
    python -m candlewick check  --warehouse DIR

On a cluster the session comes from spark-submit (master, resources,
``spark.checkpoint.dir``); locally ``--master local[*]`` builds one.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from candlewick.schema import DEFAULT_LIMIT


def _session(master: str | None) -> SparkSession:
    from candlewick.session import build_session, ensure_utc

    if master:
        return build_session(master)
    return ensure_utc(SparkSession.builder.appName("candlewick").getOrCreate())


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="candlewick")
    parser.add_argument("command", choices=["land", "run", "load", "stream", "check"])
    parser.add_argument("--landing", help="landed pages folder")
    parser.add_argument("--warehouse", help="raw, ledger and model tables")
    parser.add_argument("--pages", help="land: JSON lines or Parquet of fetched pages (symbol, body)")
    parser.add_argument("--limit", type=int, default=DEFAULT_LIMIT, help="land: candles of a full page")
    parser.add_argument("--rejects", help="land: table for malformed numbers (without it they stop the job)")
    parser.add_argument("--symbols", help="comma-separated pairs (default: all landed)")
    parser.add_argument("--strategy", default="sliced", choices=["sliced", "window"])
    parser.add_argument("--incremental", action="store_true",
                        help="run: rewrite the tables only for days that changed (the returns and trend tables from the first one on)")
    parser.add_argument("--archive", help="stream: move loaded one-file pages to this folder")
    parser.add_argument("--master", help="e.g. local[*]; omit under spark-submit")
    args = parser.parse_args(argv)
    for name in {"land": ("pages", "landing"), "check": ("warehouse",)}.get(args.command, ("landing", "warehouse")):
        if not getattr(args, name):
            parser.error(f"--{name} is required")
    spark = _session(args.master)
    wh = (args.warehouse or "").rstrip("/")
    symbols = args.symbols.split(",") if args.symbols else None

    if args.command == "land":
        from candlewick.plans.land import land_pages

        pages = spark.read.parquet(args.pages) if args.pages.endswith(".parquet") \
            else spark.read.schema("symbol string, body string").json(args.pages)
        out = vars(land_pages(pages, args.landing, args.limit, args.rejects))
    elif args.command == "run":
        from candlewick.plans.pipeline import run_pipeline

        result = run_pipeline(spark, args.landing, wh, symbols, args.strategy,
                              incremental=args.incremental)
        out = {"load_id": result.load.load_id, "files": result.load.files,
               "failed": result.load.failed, "snapshot": result.snapshot, "tables": result.tables,
               "checks": result.checks}
    elif args.command == "load":
        from candlewick.plans.load import load_incremental

        result = load_incremental(spark, args.landing, f"{wh}/raw", f"{wh}/ledger")
        out = {"load_ids": result.load_ids, "files": result.files, "failed": result.failed}
    elif args.command == "stream":
        from candlewick.streaming.incremental import run_stream_once

        run_stream_once(spark, args.landing, f"{wh}/raw", f"{wh}/ledger", f"{wh}/raw_stream_checkpoint",
                        rejects=f"{wh}/rejected", archive=args.archive)
        out = {"table": f"{wh}/raw", "rejected": f"{wh}/rejected"}
    else:
        from candlewick.operators.quality import assert_checks, assert_grain, run_checks, run_grain_checks
        from candlewick.plans.pipeline import MODELS
        from candlewick.sinks.models import Warehouse

        house = Warehouse(spark, wh)
        snapshot = house.current()
        models = {name: house.read(name, snapshot) for name in ["stg_klines", *MODELS]}
        models["stg_klines"] = models["stg_klines"].drop("date")
        out = {"checks": assert_checks(run_checks(models)), "grain": assert_grain(run_grain_checks(models))}
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
