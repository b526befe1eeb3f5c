"""Business-register XML: scan, parse and flatten to registry records.

A record is an element whose local name is one of ``RECORD_TAGS``, in any case and
under any namespace prefix. The files are read as text that is split at ``>``, so a
large file is split over tasks whatever its line breaks are, and all record names
are found in the same pass; the pieces between a record's start tag and the next
one are put together again, across file blocks too.

A field is the first element with its (case-sensitive) local name at any depth of
the record, in document order: its own leading text, stripped. An absent or empty
element is NULL, one of white space ``""``. The fallback chain of a field takes the
first non-empty value, else the last candidate as it is.

Limits: ``>`` inside attribute values or comments, and a record inside a record
(the inner one is read; what is left of the outer one counts as malformed).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmlink.functions.dates import with_norm_date
from firmlink.functions.html import decode_entities
from firmlink.functions.text import or_chain, py_strip
from firmlink.operators.project import project_once

CORRUPT_COLUMN = "_corrupt"

# Local names of record elements (any case).
RECORD_TAGS = ("abr", "entity", "entityrecord", "record")

# Output field -> elements, in order of preference.
FIELD_ELEMENTS = {
    "abn": ("ABN",),
    "entity_name": ("NonIndividualNameText", "OrganisationName", "EntityName"),
    "entity_type": ("EntityTypeText", "EntityType"),
    "entity_status": ("ABNStatus", "EntityStatus"),
    "address": ("AddressLine", "StreetAddress"),
    "postcode": ("Postcode",),
    "state": ("State",),
    "start_date": ("ABNStatusFromDate", "StartDate"),
}

XML_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN, "ignoreNamespace": "true"}

_PREFIX = r"(?:[\w.\-]+:)?"
_FILE_COLUMNS = ("_metadata.file_path", "_metadata.file_block_start")


def _names(tags: Sequence[str]) -> str:
    return "(?:" + "|".join(tags) + ")"


def xml_pieces(reader, path: str) -> DataFrame:
    """``(value, _file, _block)``: the text before each ``>`` of the files.
    ``reader``: ``spark.read`` or ``spark.readStream``."""
    file_path, block = _FILE_COLUMNS
    return reader.format("text").option("lineSep", ">").load(path).select(
        "value", F.col(file_path).alias("_file"), F.col(block).alias("_block"))


def records_from_pieces(pieces: DataFrame, tags: Sequence[str] = RECORD_TAGS) -> DataFrame:
    """Record texts ``(xml, _file, _block, _row)``; the last three give the
    input order.

    Start tags are numbered within each file block, and a file's blocks are
    offset by the start tags before them (one row per block), so a record that
    crosses blocks is one group and no file is numbered by one task.
    """
    start = F.rlike("value", F.lit(rf"(?is)<{_PREFIX}{_names(tags)}(?:\s[^<]*)?$")) & ~F.endswith("value", F.lit("/"))
    p = pieces.withColumn("_row", F.monotonically_increasing_id()).withColumn("_start", start.cast("int"))
    in_block = Window.partitionBy("_file", "_block").orderBy("_row")
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = p.groupBy("_file", "_block").agg(F.sum("_start").alias("_n"))
    blocks = blocks.select("_file", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = p.withColumn("_nr", F.sum("_start").over(in_block)).join(blocks, ["_file", "_block"])
    numbered = numbered.withColumn("_nr", F.col("_nr") + F.col("_before")).where("_nr > 0")
    text = F.when(F.col("_start") == 1, F.concat(F.lit("<"), F.substring_index("value", "<", -1))).otherwise(F.col("value"))
    whole = numbered.groupBy("_file", "_nr").agg(
        F.sort_array(F.collect_list(F.struct("_block", "_row", text.alias("text")))).alias("parts"))
    xml = F.concat(F.array_join(F.col("parts.text"), ">"), F.lit(">"))
    closed = F.regexp_extract("_all", rf"(?is)^(.*</{_PREFIX}{_names(tags)}\s*>)", 1)
    return whole.select("_file", F.col("parts")[0]["_block"].alias("_block"), F.col("parts")[0]["_row"].alias("_row"), xml.alias("_all")).select(
        F.when(closed != "", closed).otherwise(F.col("_all")).alias("xml"), "_file", "_block", "_row")


def read_registry_xml(spark: SparkSession, path: str, tags: Sequence[str] = RECORD_TAGS) -> DataFrame:
    """The records of XML files, parsed (see ``parse_registry_xml``), with an
    input-order ordinal ``(_file, _block, _row)`` for keep-first loads."""
    return parse_registry_xml(records_from_pieces(xml_pieces(spark.read, path), tags))


def parse_registry_xml(df: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Check one XML record per row of a string column: ``_corrupt`` holds the
    text of a malformed one. Prefixes are dropped first: they may be declared
    outside the record.

    Records are dealt evenly over the session's shuffle partitions first: parsing
    costs far more than reading, and inputs of few bytes come in few partitions,
    however many records they hold."""
    df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bare = F.regexp_replace(F.regexp_replace(F.col(xml_col), r"(</?)[\w.\-]+:", "$1"), r"\s[\w.\-]+:(?=[\w.\-]+\s*=)", " ")
    parsed = F.from_xml(bare, f"_any string, {CORRUPT_COLUMN} string", XML_OPTIONS)
    others = [c for c in df.columns if c != CORRUPT_COLUMN]
    # inline() makes the parse a Generate node: it runs once per record even
    # when later filters read its result.
    return df.select(*others, F.inline(F.array(parsed))).drop("_any")


def elements(xml: Column, names: Sequence[str]) -> Column:
    """The elements with these local names in document order, as an array of
    ``(name, value)``, from one scan of the record. A value is the leading text,
    stripped; NULL when it is empty."""
    tag = rf"(?s)<{_PREFIX}{_names(names)}(?:\s[^>]*?)?(?:/>|>[^<]*(?:<!\[CDATA\[.*?\]\]>)?)"

    def parts(found: Column) -> Column:
        text = F.regexp_extract(found, r">([^<]*)", 1)
        value = F.concat(decode_entities(text), F.regexp_extract(found, r"(?s)<!\[CDATA\[(.*)\]\]>$", 1))
        return F.struct(F.regexp_extract(found, rf"^<{_PREFIX}([\w.\-]+)", 1).alias("name"),
                        py_strip(F.nullif(value, F.lit(""))).alias("value"))

    return F.transform(F.regexp_extract_all(xml, F.lit(tag), F.lit(0)), parts)


def first_value(found: str, name: str) -> Column:
    """Value of the first element of this name in a column of :func:`elements`; NULL
    when there is none."""
    return F.get(F.filter(F.col(found), lambda e: e["name"] == name), F.lit(0))["value"]


def flatten_registry(parsed: DataFrame, keep: Sequence[str] = (), xml_col: str = "xml") -> DataFrame:
    """Registry fields by their fallback chains. ``start_date_raw`` is the date
    text as found; ``parse_failed`` marks malformed records."""
    names = [n for ns in FIELD_ELEMENTS.values() for n in ns]
    found = project_once(parsed, [*keep, CORRUPT_COLUMN], {"_elements": elements(F.col(xml_col), names)})
    fields = {"start_date_raw" if f == "start_date" else f: or_chain(*[first_value("_elements", n) for n in ns])
              for f, ns in FIELD_ELEMENTS.items()}
    return project_once(found, list(keep), fields | {"parse_failed": F.col(CORRUPT_COLUMN).isNotNull()})


def with_start_date(flat: DataFrame) -> DataFrame:
    return with_norm_date(flat, "start_date_raw", "start_date")
