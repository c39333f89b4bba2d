"""Summarise the planning-time physical plan of every registered query.

For each query: shuffles (hash-partitioning exchanges), broadcast and
sort-merge joins, aggregates, Parquet scans with pushed filters, and any
Cartesian / nested-loop join or Python evaluation. Writes two Markdown tables: the plans with all size checks
passed, and those beyond the bounds (every size check fails) of the queries that differ.
Usage: python scripts/plan_summary.py [sf_dir] > tables.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from appmart import catalog  # noqa: E402
from appmart.operators import joins, quality  # noqa: E402
from appmart.session import build_session  # noqa: E402


def summarise(plan: str) -> dict[str, int]:
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "broadcast joins": len(re.findall(r"BroadcastHashJoin", plan)),
        "sort-merge joins": len(re.findall(r"SortMergeJoin", plan)),
        "hash aggregates": len(re.findall(r"HashAggregate", plan)),
        "parquet scans": len(re.findall(r"FileScan parquet", plan)),
        "scans with pushed filters": len(re.findall(r"PushedFilters: \[[^\]]", plan)),
        "product / nested loop / python": len(re.findall(
            r"CartesianProduct|NestedLoopJoin|BatchEvalPython|ArrowEvalPython", plan)),
    }


def plans(spark, sf_dir: str) -> dict[str, dict[str, int]]:
    found = {}
    for key, build in catalog.registry().items():
        df = build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        # The plan chosen at planning time (the write above runs its own copy,
        # so this is the initial plan inside AdaptiveSparkPlan, before AQE).
        found[key] = summarise(df._jdf.queryExecution().executedPlan().toString())
    return found


def table(found: dict[str, dict[str, int]]) -> None:
    cols = list(next(iter(found.values())))
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for key, s in found.items():
        print(f"| {key} | " + " | ".join(str(s[c]) for c in cols) + " |")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    within = plans(spark, sf_dir)
    table(within)
    joins.fits = lambda *a, **k: False
    quality.fits = joins.fits
    beyond = plans(spark, sf_dir)
    print()
    table({k: v for k, v in beyond.items() if v != within[k]})


if __name__ == "__main__":
    main()
