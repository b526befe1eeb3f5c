"""Registered queries: one per operator group of the survey, each a function
``(spark, sf_dir) -> DataFrame`` over the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlink import fixtures as fx
from firmlink.config import MatchConfig
from firmlink.functions.dates import norm_date
from firmlink.functions.html import MAX_STORED_HTML_CHARS, extract_company_fields
from firmlink.functions.text import block_key, norm_name
from firmlink.functions.url import row_hash, url_domain, url_hash
from firmlink.operators.confirm import apply_verdicts
from firmlink.operators.dedup import insert_if_absent, keep_first
from firmlink.operators.match import band
from firmlink.operators.materialize import materialize
from firmlink.operators.metrics import band_counts, match_metrics, stage_metrics
from firmlink.plans.stage_crawl import crawl_rows, stage_crawl
from firmlink.plans.stage_registry import RECORD_FIELDS, stage_registry
from firmlink.plans.unify import exact_matches, match_stages, unify
from firmlink.schemas import CRAWL, CRAWL_FIELDS, REGISTRY_FIELDS, UNIFIED
from firmlink.sources.index_hits import parse_hit_lines
from firmlink.sources.registry_xml import flatten_registry, parse_registry_xml, read_registry_xml
from firmlink.sources.tables import existing_table, read_table, scratch_path, write_quarantine, write_table

CFG = MatchConfig()


def q_normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ns = fx.name_sources(spark, sf_dir)
    n = norm_name("name")
    return ns.select("source", "id", "name", n.alias("norm_name"), block_key(n, CFG.block_chars).alias("block_key"))


def q_url_domain_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.table(spark, sf_dir, "pages")
    d = url_domain("url")
    return p.select(
        "page_id", "url", d.alias("domain"), url_hash("url").alias("url_hash"),
        row_hash("url", d, F.col("page_id")).alias("row_hash"),
    )


def q_page_company_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fp = fx.fetched_pages(spark, sf_dir)
    f = extract_company_fields(fp, "html", "http_status", ["page_id", "url", "http_status"], MAX_STORED_HTML_CHARS)
    return f.select(
        "page_id", "url", url_domain("url").alias("domain"), "http_status",
        "extracted_name", "extracted_industry", F.length("raw_html").alias("raw_html_chars"),
    )


def _hits_and_pages(spark: SparkSession, sf_dir: str):
    hits = parse_hit_lines(fx.hit_lines(spark, sf_dir))
    pages = fx.fetched_pages(spark, sf_dir).select("url", "http_status", "html")
    return hits, pages


def q_index_hits_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits, pages = _hits_and_pages(spark, sf_dir)
    return crawl_rows(hits, pages, ["line_no"], max_stored_chars=MAX_STORED_HTML_CHARS)


def q_exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg, cc = fx.unify_inputs(spark, sf_dir)
    return exact_matches(reg, cc, CFG)


def q_block_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg, cc = fx.unify_inputs(spark, sf_dir)
    st = match_stages(reg, cc, CFG)
    return st.candidates.select("r_norm", "c_norm", "r_len", "c_len", "overlap")


def q_fuzzy_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg, cc = fx.unify_inputs(spark, sf_dir)
    return match_stages(reg, cc, CFG).scored


def q_match_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg, cc = fx.unify_inputs(spark, sf_dir)
    st = match_stages(reg, cc, CFG)
    pairs = st.exact_pairs.select("r_norm", "c_norm", F.lit("EXACT").alias("band")).unionByName(
        st.scored.select("r_norm", "c_norm", band("fuzzy_score", CFG).alias("band"))
    )
    return band_counts(pairs, st.reg_best, st.crawl_best)


def _confirmed(judged: DataFrame) -> DataFrame:
    return judged.filter("confirmed").select(
        F.col("r_norm").alias("reg_norm"), F.col("c_norm").alias("crawl_norm"), "fuzzy_score"
    )


def q_confirmed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts from a table that also holds unknown pairs, repeated and
    contradicting answers."""
    reg, cc = _held_names(spark, sf_dir)
    st = match_stages(reg, cc, CFG)
    return _confirmed(apply_verdicts(st.scored, CFG, verdicts=fx.verdict_table(reg, cc)))


def q_confirmed_by_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of every borderline pair from a function that runs in the tasks."""
    reg, cc = fx.unify_inputs(spark, sf_dir)
    st = match_stages(reg, cc, CFG)
    return _confirmed(apply_verdicts(st.scored, CFG, confirmer=fx.confirm_by_length))


def q_unify_no_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg, cc = fx.unify_inputs(spark, sf_dir)
    return unify(reg, cc, CFG, with_timestamp=False)


def _held_names(spark: SparkSession, sf_dir: str):
    """Inputs whose names are taken from the pages once, for the match and for the verdicts."""
    return fx.unify_inputs(spark, sf_dir, lambda df: materialize(df, "crawl-names"))


def _unify_with_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    reg, cc = _held_names(spark, sf_dir)
    return unify(reg, cc, CFG, verdicts=fx.verdict_table(reg, cc), with_timestamp=False)


def q_unify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unify_with_verdicts(spark, sf_dir)


def q_keep_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.table(spark, sf_dir, "pages").select(url_domain("url").alias("domain"), "page_id", "url")
    return keep_first(p, ["domain"], ["page_id"])


def q_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the whole ``pages`` table: first keyed by domain, then
    keyed by the domain without a ``www.``/``m.``/``blog.`` prefix (so some
    keys exist already) with a NULL key for every tenth page."""
    p = fx.table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    domain = url_domain("url")
    first = p.select(domain.alias("key"), "page_id", "url")
    bare = F.regexp_replace(domain, r"^(www|m|blog)\.", "")
    second = p.select(
        F.when(pid % 10 == 0, F.lit(None).cast("string")).otherwise(bare).alias("key"), "page_id", "url"
    )
    first_load = keep_first(first, ["key"], ["page_id"])
    second_load = insert_if_absent(second, first_load, ["key"], ["page_id"])
    return first_load.withColumn("load", F.lit(1)).unionByName(second_load.withColumn("load", F.lit(2)))


def _registry_load(spark: SparkSession, sf_dir: str, hold=lambda df: df):
    recs = fx.registry_xml_records(spark, sf_dir)
    flat = hold(flatten_registry(parse_registry_xml(recs, "xml"), keep=["c_custkey"]))
    return flat, stage_registry(flat, ["c_custkey"], audit=False)


def q_registry_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, load = _registry_load(spark, sf_dir)
    return load.inserted.select("c_custkey", *REGISTRY_FIELDS)


def q_registry_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, load = _registry_load(spark, sf_dir)
    return load.quarantine.select("c_custkey", "reason")


def q_date_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fx.date_strings(spark, sf_dir)
    return d.select("o_orderkey", "raw", norm_date("raw").alias("start_date"))


def q_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the three loads; the parsed records, the index hits and the
    unified rows are each computed once."""
    _, load = _registry_load(spark, sf_dir, lambda df: materialize(df, "registry-parsed"))
    hits = parse_hit_lines(fx.hit_lines(spark, sf_dir)).select("line_no", url_hash("url").alias("url_hash"))
    hits = materialize(hits, "hits")
    crawl = stage_metrics(crawl_hits=hits, crawl_inserted=keep_first(hits, ["url_hash"], ["line_no"]))
    unified = match_metrics(_unify_with_verdicts(spark, sf_dir))
    return reduce(DataFrame.unionByName, [load.metrics, crawl, unified])


def q_registry_xml_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML files with records of all names, cases, prefixes and nestings."""
    flat = flatten_registry(read_registry_xml(spark, fx.registry_xml_files(spark, sf_dir)))
    return flat.select("abn", "entity_name", "entity_status", "postcode", "state", "parse_failed")


def q_quarantine_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records written to the JSON-lines quarantine and read back."""
    _, load = _registry_load(spark, sf_dir)
    path = scratch_path(spark, "quarantine")
    write_quarantine(load.quarantine, path, record_cols=RECORD_FIELDS)
    back = spark.read.schema("error string, record struct<abn:string,state:string>, reason string").json(path)
    return back.select("error", "reason", "record.abn", "record.state")


def q_rerun_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl staging and the unified table, each loaded twice into its own
    target. Every sixth page was also fetched a second time without success, hits
    repeat, and unified rows without a company number occur. The second load adds
    nothing."""
    hits, pages = _hits_and_pages(spark, sf_dir)
    again = fx.table(spark, sf_dir, "pages").select(
        "url", F.when(F.col("page_id") % 6 == 0, F.lit(503)).cast("int").alias("http_status"), F.lit(None).cast("string").alias("html"))
    pages = pages.unionByName(again)
    unified = materialize(_unify_with_verdicts(spark, sf_dir).withColumn("processed_at", F.current_timestamp()), "unified")
    out = []
    for kind, keys, shown, load in (
        ("crawl", ["url_hash", "domain"], "extracted_name", lambda t: stage_crawl(hits, pages, ["line_no"], target=t)),
        ("unified", ["abn", "domain"], "match_type",
         lambda t: insert_if_absent(unified, t, ["abn", "domain"], ["match_type"], nulls_equal=True)),
    ):
        path, schema = scratch_path(spark, f"rerun-{kind}"), CRAWL if kind == "crawl" else UNIFIED
        for n in (1, 2):
            new = load(existing_table(spark, path, schema)).select(*schema.names)
            write_table(new.withColumn("load", F.lit(n)), "parquet", "append", path)
        rows = spark.read.parquet(path)
        out.append(rows.select(F.lit(kind).alias("kind"), "load", F.col(keys[0]).alias("key"), keys[1], F.col(shown).alias("value")))
    return out[0].unionByName(out[1])


def q_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a whole table through ``write_table`` and read it back through
    ``read_table``."""
    src = fx.table(spark, sf_dir, "customer")
    path = scratch_path(spark, "roundtrip")
    write_table(src, "parquet", "overwrite", path)
    return read_table(spark, "parquet", path)


QUERIES = {
    "normalize_names": q_normalize_names,
    "url_domain_hash": q_url_domain_hash,
    "page_company_fields": q_page_company_fields,
    "index_hits_stage": q_index_hits_stage,
    "exact_match": q_exact_match,
    "block_candidates": q_block_candidates,
    "fuzzy_scores": q_fuzzy_scores,
    "match_bands": q_match_bands,
    "confirmed_pairs": q_confirmed_pairs,
    "unify_no_verdicts": q_unify_no_verdicts,
    "unify": q_unify,
    "keep_first_load": q_keep_first_load,
    "insert_if_absent": q_insert_if_absent,
    "registry_flatten": q_registry_flatten,
    "registry_quarantine": q_registry_quarantine,
    "date_normalize": q_date_normalize,
    "load_metrics": q_load_metrics,
    "registry_xml_scan": q_registry_xml_scan,
    "quarantine_sink": q_quarantine_sink,
    "rerun_loads": q_rerun_loads,
    "confirmed_by_function": q_confirmed_by_function,
    "table_roundtrip": q_table_roundtrip,
}

__all__ = ["QUERIES", "CRAWL_FIELDS"]
