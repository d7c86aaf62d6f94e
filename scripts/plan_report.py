"""Plan shapes of every registered query (initial physical plan, before AQE).

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md-table
Counts hash/range exchanges, broadcasts, join kinds, windows,
single-partition exchanges and scans, and lists pushed scan filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestar.plans.queries import QUERIES, TREE_FITS  # noqa: E402
from lodestar.session import local_session  # noqa: E402

SKIP = set(TREE_FITS)   # these fit whole tree ensembles while planning


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(shuffle_partitions=16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # show the planned shape, not the runtime one
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    print("| query | shuffles | of which reused | broadcasts | sort-merge joins | windows | single-partition | scans | pushed filters |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        p = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        c = lambda pat: len(re.findall(pat, p))
        pushed = sorted(set(m for m in re.findall(r"PushedFilters: \[(.*?)(?:\], |\.\.\., )", p) if m))
        pushed_txt = "; ".join(x[:60] for x in pushed)[:120]
        print(f"| {name} | {c(r'Exchange (?:hash|range)partitioning')} | {c(r'ReusedExchange')} | {c(r'BroadcastExchange')} "
              f"| {c(r'SortMergeJoin')} | {c(r'Window ')} | {c(r'SinglePartition')} "
              f"| {c(r'FileScan parquet')} | {pushed_txt} |")


if __name__ == "__main__":
    main()
