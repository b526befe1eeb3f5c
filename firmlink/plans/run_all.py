"""End to end: stage both sources, then unify, in one Spark application.

Storage is Parquet by default (any DataFrame source/sink works through
``read_table``/``write_table``). Staging is insert-if-absent, so a rerun
after a failure loads no row of the three tables twice (the quarantine is a log:
a rerun appends its rejects again); each write is one Spark job whose failed
tasks are retried by Spark.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from firmlink.config import MatchConfig
from firmlink.operators.dedup import insert_if_absent
from firmlink.operators.materialize import materialize, release
from firmlink.plans.stage_crawl import stage_crawl
from firmlink.plans.stage_registry import RECORD_FIELDS, stage_registry
from firmlink.plans.unify import unify
from firmlink.schemas import CRAWL, REGISTRY, UNIFIED
from firmlink.sources.index_hits import read_index_hits
from firmlink.sources.registry_xml import flatten_registry, read_registry_xml
from firmlink.sources.tables import existing_table, read_pages, write_quarantine

ORDINAL = ["_file", "_block", "_row"]


def run_all(
    spark: SparkSession,
    registry_xml: str,
    index_hits: str,
    pages: str,
    out_dir: str,
    cfg: MatchConfig = MatchConfig(),
    verdicts: DataFrame | None = None,
    max_stored_chars: int | None = None,
) -> dict[str, int]:
    """Load register and crawl into ``out_dir/{registry,crawl}``, quarantine
    bad records under ``out_dir/quarantine``, write ``out_dir/unified``.
    ``max_stored_chars`` leaves longer pages out of the stored HTML. Intermediate
    tables are deleted at the end.
    Returns the rows written by this run (``registry_inserted``,
    ``registry_quarantined``, ``crawl_inserted``, ``unified_written``) and the
    table sizes after it (``registry``, ``crawl``, ``unified``)."""
    reg_path = os.path.join(out_dir, "registry")
    crawl_path = os.path.join(out_dir, "crawl")
    unified_path = os.path.join(out_dir, "unified")

    # Both the table and the quarantine read the parsed records: parse the
    # XML once, into a table under the shared folder.
    flat = materialize(flatten_registry(read_registry_xml(spark, registry_xml), keep=ORDINAL), "registry-parsed")
    load = stage_registry(flat, ORDINAL, target=existing_table(spark, reg_path, REGISTRY))
    inserted, reg_obs = _observed(load.inserted, "registry_inserted")
    inserted.write.mode("append").parquet(reg_path)
    bad, bad_obs = _observed(load.quarantine, "registry_quarantined")
    write_quarantine(bad, os.path.join(out_dir, "quarantine"), record_cols=RECORD_FIELDS)

    hits = read_index_hits(spark, index_hits)
    new_crawl = stage_crawl(hits, read_pages(spark, pages), ORDINAL,
                            target=existing_table(spark, crawl_path, CRAWL),
                            max_stored_chars=max_stored_chars)
    new_crawl, crawl_obs = _observed(new_crawl, "crawl_inserted")
    new_crawl.write.mode("append").parquet(crawl_path)

    registry = spark.read.schema(REGISTRY).parquet(reg_path)
    crawl = spark.read.schema(CRAWL).parquet(crawl_path)
    unified = unify(registry, crawl, cfg, verdicts=verdicts).select([f.name for f in UNIFIED.fields])
    if cfg.write_mode == "insert_if_absent":
        # keep rows already in the table; add only new (abn, domain) pairs
        existing = existing_table(spark, unified_path, UNIFIED)
        unified = insert_if_absent(unified, existing, ["abn", "domain"], ["match_type"], nulls_equal=True)
        mode = "append"
    else:
        mode = "overwrite" if cfg.write_mode == "overwrite" else "append"
    unified, uni_obs = _observed(unified, "unified_written")
    unified.write.mode(mode).parquet(unified_path)

    # rows written by this run, observed during the writes (no extra pass)
    counts = {o.name: o.get["rows"] for o in (reg_obs, bad_obs, crawl_obs, uni_obs)}
    # table sizes after the run (Parquet footers)
    for name, path in (("registry", reg_path), ("crawl", crawl_path), ("unified", unified_path)):
        counts[name] = spark.read.parquet(path).agg(F.count(F.lit(1))).first()[0]
    release(spark)
    return counts


class _NamedObservation:
    def __init__(self, name: str):
        self.name = name
        self.obs = Observation(name)

    @property
    def get(self):
        return self.obs.get


def _observed(df: DataFrame, name: str):
    o = _NamedObservation(name)
    return df.observe(o.obs, F.count(F.lit(1)).alias("rows")), o
