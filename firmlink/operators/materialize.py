"""Materialise an intermediate result that several branches of a job read.

The rows are written once as a Parquet table under the cluster's shared folder
(``spark.checkpoint.dir``) and read back: the lineage is cut, so a lost executor
costs a re-read, not a recomputation from the sources. A DataFrame write (unlike
an RDD checkpoint of a cached plan) gets AQE's partition coalescing, computes the
plan once, and the read back is split by file size and pruned by column.

The tables stay until :func:`release` deletes them, which the owner of the
result calls when it has been written (``run_all`` and the command line do).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from firmlink.session import ensure_checkpoint_dir

_WRITTEN: dict[str, list[str]] = {}


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/firmlink-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the tables this application has materialised so far; returns
    their number. DataFrames that read them are no longer usable."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)
