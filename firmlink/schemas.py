"""Table layouts of the staged and unified tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), True) for n in names]


# Registry staging table (key: abn).
REGISTRY = T.StructType(
    _strings("abn", "entity_name", "entity_type", "entity_status", "address", "postcode", "state")
    + [
        T.StructField("start_date", T.DateType(), True),
        T.StructField("inserted_at", T.TimestampType(), True),
    ]
)
REGISTRY_FIELDS = [f.name for f in REGISTRY.fields if f.name != "inserted_at"]

# Crawl staging table (key: url_hash). ``extra`` holds JSON text.
CRAWL = T.StructType(
    _strings("source_url", "url_hash", "domain", "extracted_name", "extracted_industry")
    + [T.StructField("http_status", T.IntegerType(), True)]
    + _strings("raw_html", "extra")
    + [T.StructField("inserted_at", T.TimestampType(), True)]
)
CRAWL_FIELDS = [f.name for f in CRAWL.fields if f.name != "inserted_at"]

# Unified table; ``match_type`` is written as well.
UNIFIED = T.StructType(
    _strings(
        "abn", "entity_name", "entity_type", "address", "postcode", "state",
        "domain", "extracted_industry", "match_type",
    )
    + [T.StructField("processed_at", T.TimestampType(), True)]
)
UNIFIED_FIELDS = [f.name for f in UNIFIED.fields if f.name != "processed_at"]

# Fetched pages: the result of fetching each URL (status NULL = failed fetch).
PAGES = T.StructType(
    [
        T.StructField("url", T.StringType(), True),
        T.StructField("http_status", T.IntegerType(), True),
        T.StructField("html", T.StringType(), True),
    ]
)


def with_audit(df: DataFrame, column: str = "inserted_at", value: Column | None = None) -> DataFrame:
    """Add the load timestamp the table DDL would default (one value per query)."""
    return df.withColumn(column, value if value is not None else F.current_timestamp())


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema``; a missing column is an error."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
