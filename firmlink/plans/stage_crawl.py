"""Crawl staging: index hits + fetched pages -> crawl rows.

Hits are reduced first (first hit per URL hash, and only hashes absent from
the target), then joined to the pages, whose fields were extracted on the
page side: the shuffle carries names, not documents, except the stored HTML. A URL
fetched several times gives one page: a successful fetch before a failed one,
then the smallest status and extracted values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlink.functions.html import extract_company_fields
from firmlink.functions.url import url_domain, url_hash
from firmlink.operators.dedup import insert_if_absent, keep_first, pick_best
from firmlink.schemas import CRAWL, CRAWL_FIELDS, conform, with_audit
from firmlink.sources.index_hits import hit_extra


def page_fields(pages: DataFrame, max_stored_chars: int | None = None) -> DataFrame:
    """``(url, http_status, extracted_name, extracted_industry, raw_html)``,
    one row per URL."""
    p = pages.select("url", F.col("http_status").cast("int").alias("http_status"), "html")
    p = extract_company_fields(p, "html", "http_status", ["url", "http_status"], max_stored_chars)
    failed = F.when(F.col("http_status") == 200, 0).when(F.col("http_status").isNotNull(), 1).otherwise(2)
    return pick_best(p, ["url"], [failed, "http_status"])


def crawl_rows(
    hits: DataFrame,
    pages: DataFrame,
    order_by: Sequence[Column | str],
    target: DataFrame | None = None,
    max_stored_chars: int | None = None,
) -> DataFrame:
    """Crawl rows (``CRAWL_FIELDS``) to insert: ``hits`` from
    :func:`parse_hit_lines` with ordinal columns ``order_by``; ``pages`` is
    ``(url, http_status, html)``."""
    order_cols = [c for c in order_by if isinstance(c, str)]
    h = hits.select(
        *order_cols,
        F.col("url").alias("source_url"),
        url_hash("url").alias("url_hash"),
        url_domain("url").alias("domain"),
        hit_extra("hit").alias("extra"),
    )
    if target is None:
        h = keep_first(h, ["url_hash"], order_by)
    else:
        h = insert_if_absent(h, target, ["url_hash"], order_by)
    pg = page_fields(pages, max_stored_chars).withColumnRenamed("url", "source_url")
    return h.join(pg, "source_url", "left").select(*order_cols, *CRAWL_FIELDS)


def stage_crawl(hits: DataFrame, pages: DataFrame, order_by: Sequence[Column | str],
                target: DataFrame | None = None, max_stored_chars: int | None = None) -> DataFrame:
    """Rows to append to the crawl table, with ``inserted_at``."""
    return conform(with_audit(crawl_rows(hits, pages, order_by, target, max_stored_chars)), CRAWL)
