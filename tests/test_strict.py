"""Nothing is dropped or swallowed without a word; inputs are read once."""

import re

import pytest
from pyspark.errors import AnalysisException

from firmlink.operators.dedup import insert_if_absent, keep_first
from firmlink.operators.materialize import materialize, release
from firmlink.plans.stage_crawl import crawl_rows
from firmlink.schemas import CRAWL, PAGES, conform
from firmlink.session import ensure_checkpoint_dir
from firmlink.sources.index_hits import parse_hit_lines
from firmlink.sources.tables import existing_table, read_pages, scratch_path
from tests.conftest import SF001


def test_missing_input_columns_raise(spark, tmpdir_fresh):
    wrong = spark.createDataFrame([("u", 200, "x")], "url string, status int, body string")
    with pytest.raises(ValueError, match="http_status, html"):
        conform(wrong, PAGES)
    wrong.write.parquet(f"{tmpdir_fresh}/pages")
    with pytest.raises(ValueError, match="columns missing"):
        read_pages(spark, f"{tmpdir_fresh}/pages")


def test_only_a_missing_path_is_an_empty_table(spark, tmpdir_fresh):
    assert existing_table(spark, f"{tmpdir_fresh}/none", CRAWL).count() == 0
    with pytest.raises(Exception) as e:
        existing_table(spark, "nosuchstore://bucket/table", CRAWL)
    assert not isinstance(e.value, AnalysisException) or e.value.getCondition() != "PATH_NOT_FOUND"


class _Cluster:
    class conf:  # noqa: N801
        @staticmethod
        def get(*_):
            return None

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Cluster())


def test_materialized_tables_are_released(spark, tmpdir_fresh):
    release(spark)
    held = materialize(spark.range(5), "t")
    assert held.count() == 5 and release(spark) == 1
    with pytest.raises(Exception):
        spark.read.parquet(held.inputFiles()[0])


def scans(df) -> int:
    """File scans in the executed plan; a reused exchange counts once."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"FileScan|Scan parquet|BatchScan", plan))


def test_each_input_is_read_once(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    assert scans(keep_first(pages, ["url"], ["page_id"])) == 1
    target = spark.read.parquet(f"{SF001}/customer.parquet").selectExpr("c_name AS url")
    assert scans(insert_if_absent(pages, target, ["url"], ["page_id"])) == 2
    lines = spark.read.parquet(f"{SF001}/part.parquet").selectExpr("p_partkey AS line_no", "p_name AS value")
    fetched = pages.selectExpr("url", "200 AS http_status", "html")
    assert scans(crawl_rows(parse_hit_lines(lines), fetched, ["line_no"])) == 2


def test_a_page_fetched_twice_gives_one_row(spark):
    hits = parse_hit_lines(spark.createDataFrame([(1, '{"url": "http://a.io/"}'), (2, '{"url": "http://a.io/"}')], "line_no long, value string"))
    pages = spark.createDataFrame([("http://a.io/", 503, None), ("http://a.io/", 200, "<title>A</title>"), ("http://a.io/", None, None)],
                                  "url string, http_status int, html string")
    rows = crawl_rows(hits, pages, ["line_no"]).collect()
    assert [(r.line_no, r.http_status, r.extracted_name) for r in rows] == [(1, 200, "A")]


def test_null_safe_insert(spark):
    new = spark.createDataFrame([(None, "d", "x"), (None, "d", "y"), ("1", None, "z"), ("1", "e", "q")], "abn string, domain string, v string")
    first = insert_if_absent(new, new.limit(0), ["abn", "domain"], ["v"], nulls_equal=True)
    assert sorted(r.v for r in first.collect()) == ["q", "x", "z"]
    path = scratch_path(spark, "nulls")
    first.write.parquet(path)
    assert insert_if_absent(new, spark.read.parquet(path), ["abn", "domain"], ["v"], nulls_equal=True).count() == 0


def test_the_verdict_table_searches_each_title_once(spark):
    from firmlink import fixtures as fx

    reg, cc = fx.unify_inputs(spark, SF001)
    searches = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("<title")
    assert searches(fx.verdict_table(reg, cc)) == 2 * searches(cc) > 0  # once for each side
    held = fx.unify_inputs(spark, SF001, lambda df: materialize(df, "names"))
    answers = fx.verdict_table(*held)
    assert searches(answers) == 0
    assert sorted(map(tuple, answers.collect())) == sorted(map(tuple, fx.verdict_table(reg, cc).collect()))
