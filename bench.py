"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query seconds.

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver). A warm-up run on the smallest
scale factor pays JVM and Python-worker start-up first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from firmlink.catalog import QUERIES  # noqa: E402
from firmlink.session import get_spark  # noqa: E402

HEADLINE = [
    "unify", "unify_no_verdicts", "exact_match", "fuzzy_scores", "block_candidates", "match_bands",
    "confirmed_pairs", "index_hits_stage", "page_company_fields", "registry_flatten",
    "registry_quarantine", "normalize_names", "url_domain_hash", "date_normalize",
    "keep_first_load", "insert_if_absent", "load_metrics", "table_roundtrip", "registry_xml_scan",
    "quarantine_sink", "rerun_loads", "confirmed_by_function",
]


def run(spark, name, sf_dir):
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("firmlink-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        run(spark, "unify", warm)
    times = {name: round(run(spark, name, sf_dir), 3) for name in HEADLINE}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
