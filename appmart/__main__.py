"""Run the full-refresh pipeline: ``python -m appmart --src DIR [--warehouse PATH]``, or by ``submit_pipeline.py``.

Without ``--warehouse`` the tables go to the session catalog (databases
``data`` and ``analytics``); with it, to Parquet folders under PATH (a
cluster-shared location). Prints the written row counts as JSON.
"""

from __future__ import annotations

import argparse
import json

from appmart.plans.pipeline import run_pipeline
from appmart.session import build_session
from appmart.sources.tables import TableStore


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="appmart", description=__doc__.splitlines()[0])
    parser.add_argument("--src", required=True, help="folder holding <table>.csv files or folders")
    parser.add_argument("--warehouse", default=None, help="Parquet root; default: session catalog")
    parser.add_argument("--etl-ts", default=None, help="run timestamp (ISO-8601); default: now, UTC")
    parser.add_argument("--dag-execution-date", default=None,
                        help="scheduler run time (ISO-8601); default: the run timestamp")
    parser.add_argument("--db-raw", default="data", help="namespace of the raw tables")
    parser.add_argument("--db-mart", default="analytics", help="namespace of the modelled tables")
    parser.add_argument("--optional", nargs="*", default=[], metavar="TABLE",
                        help="raw tables that may have no source (then empty)")
    parser.add_argument("--workers", type=int, default=4,
                        help="independent steps of a stage run at once (1: one at a time)")
    parser.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    args = parser.parse_args(argv)

    spark = build_session(args.master)
    store = TableStore(spark, args.warehouse)
    counts = run_pipeline(spark, args.src, store, etl_ts=args.etl_ts,
                          dag_execution_date=args.dag_execution_date, workers=args.workers,
                          db_raw=args.db_raw, db_mart=args.db_mart, optional=args.optional)
    print(json.dumps(counts, sort_keys=True))


if __name__ == "__main__":
    main()
