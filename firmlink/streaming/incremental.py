"""Crawl-index hits arriving as JSON-lines files, staged per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firmlink.operators.materialize import materialize
from firmlink.plans.stage_crawl import stage_crawl
from firmlink.plans.stage_registry import RECORD_FIELDS, stage_registry
from firmlink.schemas import CRAWL, REGISTRY
from firmlink.sources.index_hits import parse_hit_lines
from firmlink.sources.registry_xml import flatten_registry, parse_registry_xml, records_from_pieces, xml_pieces
from firmlink.sources.tables import existing_table, write_quarantine

ORDINAL = ["_file", "_row"]


def crawl_hits_stream(
    spark: SparkSession,
    hits_dir: str,
    pages: DataFrame,
    target_path: str,
    checkpoint_location: str,
    max_files_per_trigger: int | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start a query that stages each new batch of hit files into the crawl
    table at ``target_path`` (Parquet), first hit per URL hash, skipping
    hashes already loaded. ``pages`` is the fetched-page table (static)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(hits_dir).select("value", F.col("_metadata.file_path").alias("_file"))

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        target = existing_table(spark, target_path, CRAWL)
        # the row ordinal is taken per micro-batch (a static DataFrame)
        batch = batch.withColumn("_row", F.monotonically_increasing_id())
        rows = stage_crawl(parse_hit_lines(batch), pages, ORDINAL, target=target)
        rows.write.mode("append").parquet(target_path)

    writer = lines.writeStream.foreachBatch(load_batch).option(
        "checkpointLocation", checkpoint_location
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def registry_xml_stream(
    spark: SparkSession,
    xml_dir: str,
    target_path: str,
    quarantine_path: str,
    checkpoint_location: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Start a query that stages each new batch of register XML files:
    valid records insert-if-absent on ``abn`` into ``target_path`` (Parquet),
    rejected ones appended to the quarantine."""
    pieces = xml_pieces(spark.readStream, xml_dir)

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        target = existing_table(spark, target_path, REGISTRY)
        order = ["_file", "_block", "_row"]
        flat = materialize(flatten_registry(parse_registry_xml(records_from_pieces(batch)), keep=order), "registry-parsed")
        load = stage_registry(flat, order, target=target)
        load.inserted.write.mode("append").parquet(target_path)
        # one folder per batch, replaced when the batch is replayed
        write_quarantine(load.quarantine, f"{quarantine_path}/batch={epoch_id}", record_cols=RECORD_FIELDS, mode="overwrite")

    writer = pieces.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
