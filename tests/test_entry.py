"""Driver contract and a DuckDB comparison at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import digest
from tests.conftest import SF001

TABLES = ["pages", "customer", "orders"]


def test_contract(spark):
    df = E.entry(spark)
    assert df.columns == ["abn", "entity_name", "entity_type", "address", "postcode", "state", "domain",
                          "extracted_industry", "match_type"]
    assert df.count() > 0
    assert set(E.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["unify", "index_hits_stage", "registry_flatten", "match_bands"])
def test_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    s = E.queries()[name](spark, SF001).toPandas()
    o = con.sql(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(o.columns)
    hs, rs = digest(s)
    ho, ro = digest(o)
    assert rs == ro and hs == ho


SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry_mod", sys.argv[1])
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", E.queries()["fuzzy_scores"](spark, sys.argv[2]).count())
"""


def test_entry_loaded_by_path_from_another_folder(tmpdir_fresh):
    # the driver imports __spark_entry__.py by path from its own folder:
    # Python workers must not need the package on their path
    import os
    import subprocess
    import sys

    script = os.path.join(tmpdir_fresh, "run.py")
    with open(script, "w") as fh:
        fh.write(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    out = subprocess.run([sys.executable, script, entry, SF001], cwd=tmpdir_fresh, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-3000:]
