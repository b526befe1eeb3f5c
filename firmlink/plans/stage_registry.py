"""Register staging: parsed XML records -> registry rows + quarantine.

Malformed records (``parse_failed``) and records with neither ``abn`` nor
``entity_name`` (``missing_key_fields``) go to quarantine; the rest are
loaded insert-if-absent on ``abn`` (first record wins; NULL ``abn`` never
conflicts). ``start_date`` is normalised on load.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlink.operators.dedup import insert_if_absent, keep_first
from firmlink.operators.metrics import stage_metrics
from firmlink.schemas import REGISTRY, REGISTRY_FIELDS, conform, with_audit
from firmlink.sources.registry_xml import with_start_date

# Quarantine reasons.
REASON_PARSE_FAILED = "parse_failed"
REASON_MISSING_KEY = "missing_key_fields"

RECORD_FIELDS = [
    "abn", "entity_name", "entity_type", "entity_status", "address", "postcode", "state", "start_date_raw",
]


@dataclass
class RegistryLoad:
    inserted: DataFrame     # rows to append to the registry table
    quarantine: DataFrame   # reason + record fields
    metrics: DataFrame      # (metric, value)


def _empty(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


def split_registry(flat: DataFrame, keep_partial: bool = False) -> DataFrame:
    """Add ``reason`` (NULL for a good record)."""
    failed = F.col("parse_failed") & F.lit(not keep_partial)
    missing = _empty("abn") & _empty("entity_name")
    reason = F.when(failed, F.lit(REASON_PARSE_FAILED)).when(missing, F.lit(REASON_MISSING_KEY))
    return flat.withColumn("reason", reason)


def stage_registry(
    flat: DataFrame,
    order_by: Sequence[Column | str],
    target: DataFrame | None = None,
    keep_partial: bool = False,
    audit: bool = True,
) -> RegistryLoad:
    """``flat`` comes from :func:`flatten_registry` and carries the ordinal
    columns named in ``order_by``."""
    flagged = split_registry(flat, keep_partial)
    good = with_start_date(flagged.filter(F.col("reason").isNull()))
    order_cols = [c for c in order_by if isinstance(c, str)]
    cols = [*order_cols, *REGISTRY_FIELDS]
    good = good.select(*cols)
    if target is None:
        new = keep_first(good, ["abn"], order_by)
    else:
        new = insert_if_absent(good, target, ["abn"], order_by)
    inserted = conform(with_audit(new), REGISTRY) if audit else new
    bad = flagged.filter(F.col("reason").isNotNull()).select(*order_cols, "reason", *RECORD_FIELDS)
    metrics = stage_metrics(
        registry_parsed=flat,
        registry_quarantined=bad,
        registry_inserted=new,
    )
    return RegistryLoad(inserted=inserted, quarantine=bad, metrics=metrics)
