"""Run counters as small DataFrames (one aggregation each, no driver loop)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def _count_row(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit(name).alias("metric"), F.col("value").cast("long").alias("value")
    )


def stage_metrics(**frames: DataFrame) -> DataFrame:
    """``(metric, value)`` rows: the row count of each named DataFrame."""
    rows = [_count_row(name, df) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, rows)


def match_metrics(unified: DataFrame) -> DataFrame:
    """Unified rows in total and per match type, in one aggregation."""
    mt = F.col("match_type")
    agg = unified.agg(
        F.count(F.lit(1)).alias("unified_rows"),
        F.count_if(mt == "EXACT").alias("unified_exact"),
        F.count_if(mt == "FUZZY_HIGH").alias("unified_fuzzy_high"),
        F.count_if(mt == "FUZZY_LLM").alias("unified_fuzzy_llm"),
    )
    names = agg.columns
    stacked = ", ".join(f"'{n}', {n}" for n in names)
    return agg.selectExpr(f"stack({len(names)}, {stacked}) as (metric, value)").select(
        "metric", F.col("value").cast("long").alias("value")
    )


def band_counts(pairs: DataFrame, reg: DataFrame, crawl: DataFrame) -> DataFrame:
    """Name pairs and row pairs per band.

    ``pairs`` holds ``(r_norm, c_norm, band)``; ``reg``/``crawl`` hold
    ``norm`` and ``n_rows`` (source rows per entry, as in the per-name tables
    of the matching plan). Row pairs are counted as ``sum(rows_r * rows_c)``
    over name pairs, without forming them.
    """
    rn = reg.groupBy(F.col("norm").alias("r_norm")).agg(F.sum("n_rows").alias("rows_r"))
    cn = crawl.groupBy(F.col("norm").alias("c_norm")).agg(F.sum("n_rows").alias("rows_c"))
    return (
        pairs.join(rn, "r_norm").join(cn, "c_norm")
        .groupBy("band")
        .agg(
            F.count(F.lit(1)).alias("name_pairs"),
            F.sum(F.col("rows_r") * F.col("rows_c")).cast("long").alias("row_pairs"),
        )
    )
