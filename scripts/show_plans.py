"""Print the formatted physical plan of registered queries.

Usage: python scripts/show_plans.py [sf_dir] key [key ...]

Look for: ``ReadSchema`` (only the needed columns), ``PushedFilters``,
``HashAggregate`` before each ``Exchange`` (partial aggregation),
``BroadcastExchange`` only on small, measured sides, and ``Window`` nodes
partitioned by ``series``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from jobtide.plans import queries as Q  # noqa: E402
from jobtide.session import get_spark  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", shuffle_partitions=16)
    for key in args:
        print(f"===== {key}")
        Q.QUERIES[key](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
