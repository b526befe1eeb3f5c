"""Table helpers: Parquet round trip and JDBC option building (a database
round trip would need a server, which this environment does not run)."""

import pytest

from firmlink.sources.tables import jdbc_read_options, read_table, scratch_path, write_table
from tests.conftest import SF001


def test_parquet_round_trip_append_and_overwrite(spark):
    src = spark.read.parquet(f"{SF001}/customer.parquet")
    path = scratch_path(spark, "t")
    write_table(src, "parquet", "overwrite", path)
    write_table(src, "parquet", "append", path)
    assert read_table(spark, "parquet", path).count() == 2 * src.count()
    write_table(src, "parquet", "overwrite", path)
    assert sorted(map(tuple, read_table(spark, "parquet", path).collect())) == sorted(map(tuple, src.collect()))


def test_jdbc_read_options():
    o = jdbc_read_options("jdbc:postgresql://h/db", "stg.registry", user="u", password="p",
                          driver="org.postgresql.Driver", partition_column="id", lower_bound=0,
                          upper_bound=1000, num_partitions=8)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "8" and o["dbtable"] == "stg.registry"
    assert "partitionColumn" not in jdbc_read_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x", "t", partition_column="id")


def test_cli_option_parsing():
    from firmlink.cli import parse_options

    assert parse_options(["url=jdbc:postgresql://h/db?ssl=true", "user=u"]) == {
        "url": "jdbc:postgresql://h/db?ssl=true", "user": "u"}
    with pytest.raises(ValueError):
        parse_options(["novalue"])
