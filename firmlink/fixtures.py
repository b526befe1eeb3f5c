"""Inputs in the reference's formats, derived by Spark from the test tables.

The reference ships no sample data, so every query input is computed from the
driver's tables (``pages``, ``customer``, ``orders``); its size grows with
them. The same rules are written in SQL in ``oracle_queries.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlink.functions.html import html_title_name
from firmlink.functions.text import norm_name
from firmlink.functions.url import url_domain
from firmlink.operators.project import project_once
from firmlink.sources.tables import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Australian state codes used to fill the registry fixtures.
STATES = ("NSW", "VIC", "QLD", "WA", "SA", "TAS", "ACT", "NT")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


# --- matching fixture ------------------------------------------------------

def crawl_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cc``: one crawl row per page, name from the title (searched once a page,
    however often the name is used)."""
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    industry = F.when(pid % 4 == 3, F.lit(None).cast("string")).otherwise(
        _pick(("Mining", "Retail", "Finance"), pid % 3)
    )
    return project_once(p, ["page_id", "url"], {
        "domain": url_domain("url"),
        "extracted_name": html_title_name("html"),
        "extracted_industry": industry,
    })


def registry_names(cc: DataFrame) -> DataFrame:
    """``reg``: one registry row per crawl row, its name derived by
    ``page_id % 4``: exact (+ suffix), two characters short, three quarters,
    reversed (no match). ``page_id % 10 = 6`` has no company number."""
    pid = F.col("page_id")
    nm = F.col("extracted_name")
    ln = F.length(nm)
    name = (
        F.when(pid % 4 == 0, F.concat(nm, F.lit(" Pty Ltd")))
        .when(pid % 4 == 1, F.substring(nm, 1, F.greatest(ln - 2, F.lit(0))))
        .when(pid % 4 == 2, F.substring(nm, 1, F.floor(ln * 0.75).cast("int")))
        .otherwise(F.reverse(nm))
    )
    abn = F.when(pid % 10 == 6, F.lit(None).cast("string")).otherwise(
        (F.lit(10_000_000_000) + pid).cast("string")
    )
    return cc.select(
        "page_id",
        abn.alias("abn"),
        name.alias("entity_name"),
        F.when(pid % 3 == 0, F.lit("Australian Private Company"))
        .when(pid % 3 == 1, F.lit("Sole Trader"))
        .alias("entity_type"),
        F.concat(F.lit("Unit "), pid.cast("string"), F.lit(" Example Street")).alias("address"),
        F.lpad((pid % 9000).cast("string"), 4, "0").alias("postcode"),
        _pick(STATES, pid % 8).alias("state"),
    )


def unify_inputs(spark: SparkSession, sf_dir: str,
                 hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """``hold`` (e.g. ``materialize``) is applied to the crawl names, from which the
    registry and the verdict table are derived too."""
    cc = hold(crawl_names(spark, sf_dir))
    return registry_names(cc), cc


def verdict_table(registry: DataFrame, crawl: DataFrame) -> DataFrame:
    """Answers ``(reg_norm, crawl_norm, answer)`` from the names alone: for the
    two names of every page, which need not be a borderline pair, or a pair of
    the match at all. By ``length(reg_norm) % 3``: ``Yes.`` (0), ``No`` (1), no
    answer (2). Where the length is a multiple of 6 the answer is given twice;
    where it is odd and a multiple of 3 a ``no`` contradicts it. Pairs of the
    name with itself reversed are unknown to every match."""
    r = project_once(registry, ["page_id"], {"reg_norm": norm_name("entity_name")})
    c = project_once(crawl, ["page_id"], {"crawl_norm": norm_name("extracted_name")})
    pairs = r.join(c, "page_id").where("reg_norm IS NOT NULL AND crawl_norm IS NOT NULL").select("reg_norm", "crawl_norm").distinct()
    ln = F.length("reg_norm")
    yes, no = F.lit("  YES, the same"), F.lit("No")
    answers = F.when(ln % 6 == 0, F.array(F.lit("Yes."), yes)).when(ln % 3 == 0, F.array(no, yes)).when(ln % 3 == 1, F.array(no))
    answers = F.coalesce(answers, F.array().cast("array<string>"))
    known = F.transform(answers, lambda a: F.struct(F.col("crawl_norm").alias("crawl_norm"), a.alias("answer")))
    strange = F.struct(F.reverse("reg_norm").alias("crawl_norm"), F.lit("Yes.").alias("answer"))
    return pairs.select("reg_norm", F.inline(F.concat(known, F.array(strange))))


def confirm_by_length(pairs):
    """A confirmation function for tests and queries: ``yes`` when the registry
    name's length is a multiple of 3."""
    return pairs["reg_norm"].map(lambda n: "yes" if len(n) % 3 == 0 else "no, different")


# --- fetched pages and index hits --------------------------------------------

def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, http_status, html)``: 404 for ``page_id % 7 = 0``,
    failed fetch (NULL status and body) for ``% 11 = 0``; by ``page_id % 5``
    a microdata or meta snippet is put in front of the page."""
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    sid = pid.cast("string")
    snippet = (
        F.when(pid % 5 == 1, F.concat(F.lit('<meta property="og:site_name" content="Site &euro;&ntilde; &#8364;&#x41; &amp;lt; '), sid, F.lit('">')))
        .when(pid % 5 == 2, F.lit('<meta property="og:site_name" content=""><meta property="og:title" content="X">'))
        .when(
            pid % 5 == 3,
            F.concat(
                F.lit('<div itemtype="https://schema.org/Organization"><span itemprop="name"> Org '),
                sid,
                F.lit(" </span></div>"),
            ),
        )
        .when(pid % 5 == 4, F.lit('<meta name="keywords" content=" mining, gold"><meta name="industry" content="Retail">'))
        .otherwise(F.lit(""))
    )
    status = F.when(pid % 11 == 0, F.lit(None).cast("int")).when(pid % 7 == 0, F.lit(404)).otherwise(F.lit(200))
    html = F.when(pid % 11 == 0, F.lit(None).cast("string")).otherwise(F.concat(snippet, F.col("html")))
    return p.select("page_id", "url", status.alias("http_status"), html.alias("html"))


def hit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl-index output as text lines ``(line_no, value)``.

    Per page: a hit with ``url`` (even ``page_id``) or ``original`` (odd),
    or with neither key (``% 17 = 0``); a second hit for the same URL
    (``% 9 = 0``); a hit whose page was never fetched (``% 13 = 0``); a
    malformed line (``% 19 = 0``), a blank line (``% 23 = 0``) and a JSON
    array (``% 29 = 0``).
    """
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    length = F.length("html").cast("string")
    url = F.col("url")

    def obj(*kv: Column) -> Column:
        return F.concat(F.lit("{"), *kv, F.lit("}"))

    meta = [F.lit('"length":'), length, F.lit(',"mime":"text/html"')]
    with_url = obj(*meta, F.lit(',"status":"200","url":"'), url, F.lit('"'))
    with_original = obj(*meta, F.lit(',"original":"'), url, F.lit('","status":"200"'))
    no_url = obj(*meta, F.lit(',"status":"200"'))
    first = F.when(pid % 17 == 0, no_url).when(pid % 2 == 0, with_url).otherwise(with_original)
    again = obj(F.lit('"length":0,"mime":"text/html","status":"200","url":"'), url, F.lit('"'))
    unfetched = obj(*meta, F.lit(',"status":"200","url":"'), url, F.lit('?nofetch=1"'))
    lines = F.array(
        F.struct(F.lit(0).alias("k"), first.alias("value")),
        F.struct(F.lit(1).alias("k"), F.when(pid % 9 == 0, again).alias("value")),
        F.struct(F.lit(2).alias("k"), F.when(pid % 13 == 0, unfetched).alias("value")),
        F.struct(F.lit(3).alias("k"), F.when(pid % 19 == 0, F.concat(F.lit('{"url": "'), url)).alias("value")),
        F.struct(F.lit(4).alias("k"), F.when(pid % 23 == 0, F.lit("")).alias("value")),
        F.struct(F.lit(5).alias("k"), F.when(pid % 29 == 0, F.concat(F.lit('["'), url, F.lit('"]'))).alias("value")),
    )
    return (
        p.select(pid, F.inline(lines))
        .filter(F.col("value").isNotNull())
        .select((pid * 10 + F.col("k")).alias("line_no"), "value")
    )


# --- registry XML ------------------------------------------------------------

def _el(name: str, value: Column, prefix: str = "") -> Column:
    return F.concat(F.lit(f"<{prefix}{name}>"), value, F.lit(f"</{prefix}{name}>"))


def registry_xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One XML record string per customer ``(c_custkey, xml)``.

    By ``c_custkey % 6``: 0 primary element names; 1 last fallback names;
    2 whitespace-only or empty primaries plus fallbacks; 3 no company number;
    4 neither number nor name; 5 repeats the number of ``c_custkey - 5``.
    ``% 50 = 7`` is written with a namespace prefix, ``% 50 = 19`` has a bare
    ``&`` in the name (malformed).
    """
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    v = k % 6
    abn_of = lambda key: F.lpad(key.cast("string"), 11, "0")
    abn = F.when(v == 5, abn_of(k - 5)).otherwise(abn_of(k))
    name = F.when(k % 50 == 19, F.concat(F.col("c_name"), F.lit(" & Sons"))).otherwise(F.col("c_name"))
    etype = F.col("c_mktsegment")
    status = F.when(F.col("c_acctbal") >= 0, F.lit("ACT")).otherwise(F.lit("CAN"))
    addr = F.concat(F.lit("Level "), F.col("c_nationkey").cast("string"), F.lit(" Market St"))
    pc = F.lpad((F.col("c_nationkey") * 100).cast("string"), 4, "0")
    st = _pick(STATES, F.col("c_nationkey") % 8)
    day = F.date_add(F.lit("1990-01-01").cast("date"), ((k * 37) % 10000).cast("int"))
    dt = (
        F.when(k % 3 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(k % 3 == 1, F.date_format(day, "yyyyMMdd"))
        .otherwise(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("Z")))
    )
    primary = F.concat(
        _el("ABN", abn), _el("NonIndividualNameText", name), _el("EntityTypeText", etype),
        _el("ABNStatus", status), _el("AddressLine", addr), _el("Postcode", pc), _el("State", st),
        _el("ABNStatusFromDate", dt),
    )
    fallback = F.concat(
        _el("ABN", abn), _el("EntityName", name), _el("EntityType", etype), _el("EntityStatus", status),
        _el("StreetAddress", addr), _el("Postcode", pc), _el("State", st), _el("StartDate", dt),
    )
    blanks = F.concat(
        _el("ABN", abn), _el("NonIndividualNameText", F.lit("   ")), _el("OrganisationName", name),
        _el("EntityTypeText", F.lit("")), _el("EntityType", etype), _el("ABNStatus", F.lit("  ")),
        _el("AddressLine", F.lit(" ")), _el("Postcode", F.lit("  ")), _el("State", st),
        _el("StartDate", dt),
    )
    no_abn = F.concat(
        _el("NonIndividualNameText", name), _el("EntityTypeText", etype), _el("Postcode", pc),
        _el("State", st),
    )
    no_key = F.concat(_el("EntityTypeText", etype), _el("ABNStatus", status), _el("State", st))
    ns = F.concat(
        _el("ABN", abn, "n:"), _el("EntityName", name, "n:"), _el("EntityType", etype, "n:"),
        _el("Postcode", pc, "n:"), _el("State", st, "n:"),
    )
    body = (
        F.when(k % 50 == 7, ns)
        .when(v == 0, primary)
        .when(v == 1, fallback)
        .when(v == 2, blanks)
        .when(v == 3, no_abn)
        .when(v == 4, no_key)
        .otherwise(primary)
    )
    xml = (
        F.when(k % 50 == 7, F.concat(F.lit('<n:ABR xmlns:n="urn:abr">'), body, F.lit("</n:ABR>")))
        .otherwise(F.concat(F.lit("<ABR>"), body, F.lit("</ABR>")))
    )
    return c.select("c_custkey", xml.alias("xml"))


def registry_xml_files(spark: SparkSession, sf_dir: str) -> str:
    """Writes XML files (under the shared folder) with one record per customer
    and returns their folder. By ``c_custkey % 6``: nested groups with attributes,
    a lower-case record name, ``Entity``, ``EntityRecord`` under a prefix,
    ``RECORD`` on several lines, a second nested name behind an empty one, and a self-closed element (the first, so no state)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    abn, name = F.lpad(k.cast("string"), 11, "0"), F.col("c_name")
    state = _pick(STATES, F.col("c_nationkey") % 8)
    pc = F.lpad((F.col("c_nationkey") * 100).cast("string"), 4, "0")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    forms = [
        text('<ABR recordLastUpdatedDate="20200101"><ABN status="ACT">', abn, "</ABN><MainEntity><NonIndividualName type=\"MN\">"
             "<NonIndividualNameText>", name, "</NonIndividualNameText></NonIndividualName><BusinessAddress><AddressDetails><State>",
             state, "</State><Postcode>", pc, "</Postcode></AddressDetails></BusinessAddress></MainEntity></ABR>"),
        text("<abr><ABN>", abn, "</ABN><OtherEntity><NonIndividualName><NonIndividualNameText> A&amp;B ", name,
             " </NonIndividualNameText></NonIndividualName></OtherEntity></abr>"),
        text("<Entity><EntityName>", name, "</EntityName><ABN>", abn, "</ABN><State>", state, "</State></Entity>"),
        text("<x:EntityRecord xmlns:x='urn:x'><x:Id><x:ABN x:a='1'>", abn, "</x:ABN></x:Id><x:OrganisationName>", name,
             "</x:OrganisationName></x:EntityRecord>"),
        text("<RECORD\n  kind='a'>\n <ABN>\n", abn, "\n</ABN>\n<deep><er><Postcode>", pc, "</Postcode></er></deep></RECORD>"),
        text("<ABR><ABN>", abn, "</ABN><NonIndividualNameText/><Other><EntityName>", name, "</EntityName></Other><State />"
             "<Inner><State>", state, "</State></Inner></ABR>"),
    ]
    record = F.lit(None).cast("string")
    for i, f in enumerate(forms):
        record = F.when(k % 6 == i, f).otherwise(record)
    path = scratch_path(spark, "registry-xml")
    c.select(record.alias("value")).write.text(path)
    return path


# --- dates ---------------------------------------------------------------------

def date_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(o_orderkey, raw)``: the order date written in nine ways by
    ``o_orderkey % 9`` (ISO, ISO+Z, ISO date-time with offset, yyyyMMdd,
    blank, junk, M/d/yyyy, d MMMM yyyy, MMMM d, yyyy)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.to_date("o_orderdate")
    raw = (
        F.when(k % 9 == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(k % 9 == 1, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("Z")))
        .when(k % 9 == 2, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T01:30:00+10:00")))
        .when(k % 9 == 3, F.date_format(d, "yyyyMMdd"))
        .when(k % 9 == 4, F.lit("  "))
        .when(k % 9 == 5, F.lit("junk"))
        .when(k % 9 == 6, F.date_format(d, "M/d/yyyy"))
        .when(k % 9 == 7, F.date_format(d, "d MMMM yyyy"))
        .otherwise(F.date_format(d, "MMMM d, yyyy"))
    )
    return o.select("o_orderkey", raw.alias("raw"))


def name_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source, id, name)`` over crawl names, registry names and customer
    names."""
    reg, cc = unify_inputs(spark, sf_dir)
    cust = table(spark, sf_dir, "customer")
    return (
        cc.select(F.lit("crawl").alias("source"), F.col("page_id").alias("id"), F.col("extracted_name").alias("name"))
        .unionByName(reg.select(F.lit("registry").alias("source"), F.col("page_id").alias("id"),
                                F.col("entity_name").alias("name")))
        .unionByName(cust.select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"),
                                 F.col("c_name").alias("name")))
    )


__all__ = [
    "crawl_names", "registry_names", "unify_inputs", "verdict_table", "confirm_by_length", "registry_xml_files", "fetched_pages", "hit_lines",
    "registry_xml_records", "date_strings", "name_sources", "norm_name",
]
