"""Date normalisation of free-form register dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlink.functions.text import _c, py_strip

# ISO date or date-time (the wall-clock date is kept; no zone shift).
ISO_DATE_TIME = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d([.,]\d+)?)?)?([+-]\d{2}:?\d{2})?)?$"
)

# The lenient formats tried after ISO, each behind its own
# shape test; month-first before day-first.
LENIENT_FORMATS = (
    (r"^\d{8}$", ("yyyyMMdd",)),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", ("yyyy/M/d",)),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", ("M/d/yyyy", "d/M/yyyy")),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", ("M-d-yyyy", "d-M-yyyy")),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", ("M.d.yyyy", "d.M.yyyy")),
    (r"^\d{1,2} [A-Za-z]+ \d{4}$", ("d MMMM yyyy", "d MMM yyyy")),
    (r"^\d{1,2}-[A-Za-z]+-\d{4}$", ("d-MMMM-yyyy", "d-MMM-yyyy")),
    (r"^[A-Za-z]+ \d{1,2}, \d{4}$", ("MMMM d, yyyy", "MMM d, yyyy")),
    (r"^[A-Za-z]+ \d{1,2} \d{4}$", ("MMMM d yyyy", "MMM d yyyy")),
)


def clean_date_text(col: Column | str) -> Column:
    """Strip and drop one trailing ``Z``."""
    return F.regexp_replace(py_strip(_c(col)), r"Z\z", "")


def parse_clean_date(x: Column) -> Column:
    """Parse text already passed through :func:`clean_date_text`."""
    candidates = [F.when(x.rlike(ISO_DATE_TIME), F.substring(x, 1, 10).try_cast("date"))]
    for shape, fmts in LENIENT_FORMATS:
        for fmt in fmts:
            candidates.append(F.when(x.rlike(shape), F.try_to_date(x, fmt)))
    return F.coalesce(*candidates)


def norm_date(col: Column | str) -> Column:
    """Parse a register date string to ``DATE``; NULL when it cannot be read.

    Strip, drop one trailing ``Z``, then ISO (first 10 characters of an ISO
    date or date-time), then the lenient formats. Partial dates (a bare year)
    give NULL. On wide plans prefer :func:`with_norm_date`, which evaluates
    the cleaned text once instead of once per format.
    """
    return parse_clean_date(clean_date_text(col))


def with_norm_date(df: DataFrame, src: str, dst: str) -> DataFrame:
    """``df`` plus ``dst = norm_date(src)``, with the cleaned text in its own
    projection (Spark does not inline a costly expression that the next
    projection references many times)."""
    tmp = f"_{dst}_text"
    return df.withColumn(tmp, clean_date_text(src)).withColumn(dst, parse_clean_date(F.col(tmp))).drop(tmp)
