"""Crawl-index hits: JSON lines, schemaless, kept whole as a VARIANT."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlink.functions.text import or_chain


def read_index_hits(spark: SparkSession, path: str) -> DataFrame:
    """Scan JSON-lines files into ``(value, _file, _block, _row)``; the three
    ordinal columns give the input order."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return parse_hit_lines(lines)


def parse_hit_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Hits with a usable URL: ``hit`` (variant), ``url`` and the other
    columns of ``lines``.

    Blank and malformed lines are skipped, and so are JSON values that are not
    objects. ``url`` is the ``url`` field, else ``original``; hits with
    neither (or only empty values) are skipped.
    """
    raw = F.col(value_col)
    hit = F.try_parse_json(raw)
    url = or_chain(
        F.try_variant_get(F.col("hit"), "$.url", "string"),
        F.try_variant_get(F.col("hit"), "$.original", "string"),
    )
    others = [c for c in lines.columns if c != value_col]
    return (
        lines.filter(raw.rlike(r"^\s*\{"))
        .select(*others, hit.alias("hit"))
        .filter(F.col("hit").isNotNull())
        .withColumn("url", url)
        .filter(F.col("url").isNotNull() & (F.col("url") != ""))
    )


def hit_extra(hit_col: str = "hit"):
    """``{"cc_index": <hit>}`` as JSON text (object keys come out sorted)."""
    return F.to_json(F.struct(F.col(hit_col).alias("cc_index")))
