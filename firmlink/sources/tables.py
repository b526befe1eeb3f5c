"""Table reads and writes (Parquet, JDBC or any DataFrame source) and the
quarantine sink."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlink.schemas import PAGES, conform
from firmlink.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, fmt: str = "parquet", path: str | None = None, **options) -> DataFrame:
    """Whole-table read. For ``fmt="jdbc"`` pass ``url``, ``dbtable``,
    ``user``, ``password``, ``driver`` and, for a parallel read,
    ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions`` (without
    them the JDBC source reads in a single task)."""
    reader = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()})
    return reader.load(path) if path is not None else reader.load()


def write_table(df: DataFrame, fmt: str = "parquet", mode: str = "append", path: str | None = None,
                partition_by: list[str] | None = None, **options) -> None:
    """Append or overwrite a table. JDBC takes ``batchsize`` and
    ``numPartitions`` to bound the write parallelism per database."""
    w = df.write.format(fmt).mode(mode).options(**{k: str(v) for k, v in options.items()})
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path) if path is not None else w.save()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder for
    intermediate tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/firmlink-{name}-{uuid.uuid4().hex}"


def existing_table(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    """The table at ``path``, or an empty one when nothing is stored there yet.
    Any other read error is raised: an unreachable store is not an empty
    table."""
    try:
        return spark.read.format(fmt).options(**options).schema(schema).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Fetched pages ``(url, http_status, html)``: one row per URL, status NULL
    for a failed fetch."""
    return conform(spark.read.format(fmt).load(path), PAGES)


def quarantine_time():
    """UTC ``yyyyMMdd'T'HHmmss'Z'`` of the query start."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, "yyyyMMdd'T'HHmmss'Z'")


def quarantine_lines(bad: DataFrame, record_cols: list[str], reason_col: str = "reason") -> DataFrame:
    """``{"error": <reason>, "record": {<fields>}, "quarantine_time": ...}``
    rows (plus ``reason_col`` for the folder split)."""
    return bad.select(
        F.col(reason_col).alias("error"),
        F.struct(*record_cols).alias("record"),
        quarantine_time().alias("quarantine_time"),
        F.col(reason_col),
    )


def write_quarantine(bad: DataFrame, path: str, reason_col: str = "reason",
                     record_cols: list[str] | None = None, mode: str = "append") -> None:
    """Append rejected records as JSON lines, one folder per reason. With
    ``record_cols`` each line is ``{"error", "record", "quarantine_time"}``;
    otherwise the columns are written flat with ``quarantine_time``."""
    if record_cols is not None:
        out = quarantine_lines(bad, record_cols, reason_col)
    else:
        out = bad.withColumn("quarantine_time", quarantine_time())
    out.write.mode(mode).partitionBy(reason_col).json(path)


def jdbc_read_options(url: str, table: str, user: str | None = None, password: str | None = None,
                      driver: str | None = None, partition_column: str | None = None,
                      lower_bound: int | None = None, upper_bound: int | None = None,
                      num_partitions: int | None = None, fetchsize: int | None = None) -> dict[str, str]:
    """Options of a parallel JDBC table read. Without a partition column the
    source reads the whole table in one task; with one, all of the bounds and
    the partition count are required (rows outside the bounds are still read,
    by the first and last partitions)."""
    opts = {"url": url, "dbtable": table}
    for k, v in (("user", user), ("password", password), ("driver", driver), ("fetchsize", fetchsize)):
        if v is not None:
            opts[k] = str(v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, **kwargs)).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", user: str | None = None,
               password: str | None = None, driver: str | None = None, batchsize: int = 1000,
               num_partitions: int | None = None) -> None:
    """Append or overwrite a database table in batches; ``num_partitions``
    bounds the number of concurrent connections."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize)}
    for k, v in (("user", user), ("password", password), ("driver", driver), ("numPartitions", num_partitions)):
        if v is not None:
            opts[k] = str(v)
    df.write.format("jdbc").mode(mode).options(**opts).save()
