"""Command line for the daily load (the application's entry point).

    spark-submit --py-files barsmith.zip barsmith/__main__.py run \\
        --payloads s3://landing/2023-07-11 --table finance.bars \\
        --buckets 512 [--process-date 2023-07-11] [--lenient] \\
        [--rejects finance.bar_rejects] [--whole-files]

or ``python -m barsmith run ...`` where pyspark is installed.
Only this entry point builds a SparkSession; master, resources and the
shared ``spark.checkpoint.dir`` come from spark-submit / spark-defaults.
Prints the run report as one JSON line.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="barsmith")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="load one batch of landed payloads")
    r.add_argument("--payloads", required=True, action="append",
                   help="landing path (repeat for several landings)")
    r.add_argument("--table", required=True, help="target table, e.g. finance.bars")
    r.add_argument("--process-date", default=None, help="yyyy-MM-dd; default today")
    r.add_argument("--lenient", action="store_true", help="malformed values become NULL")
    r.add_argument("--buckets", type=int, required=True, help="bucket count for a new table")
    r.add_argument("--rejects", default=None, help="table for reject rows")
    r.add_argument("--whole-files", action="store_true",
                   help="one (possibly multi-line) JSON document per file")
    r.add_argument("--symbols", default=None, help="comma-separated symbols to load")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from pyspark.sql import SparkSession

    from barsmith.plans.etl import run

    spark = SparkSession.builder.appName("barsmith-daily").getOrCreate()
    report = run(
        spark,
        args.payloads,
        args.table,
        args.process_date,
        strict=not args.lenient,
        wholetext=args.whole_files,
        symbols=args.symbols.split(",") if args.symbols else None,
        buckets=args.buckets,
        reject_table=args.rejects,
    )
    print(json.dumps(dataclasses.asdict(report)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
