"""Print the formatted physical plan of every registered query.

    python tools/explain_all.py [sf_dir] [name ...] > plans.txt

Queries that materialise intermediates run those jobs first (their plans then
read the materialised tables).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from firmlink.catalog import QUERIES
    from firmlink.session import get_spark

    spark = get_spark("explain", master="local[8]", shuffle_partitions=16)
    for name in names or list(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        print(f"===== {name} =====")
        df.explain("formatted")
        sys.stdout.flush()


if __name__ == "__main__":
    main()
