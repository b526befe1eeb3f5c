"""URL filters by redirect equivalence [native DataFrame functions only].

A rule is ``(host, path prefix, allow | block)``. It fits its host and all
subdomains when the url's path starts with the rule's path; the longest fitting
rule decides. URLs joined by redirects or canonical links form one equivalence
class (connected components); a block decision on any URL of a class holds for
its members without a rule of their own. An explicit allow rule takes
precedence over a block that comes from an alias.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlink.llm.common import Tables, components, free_name

# The rules (kind, host, path prefix).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]*)"""
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.-]*://"
DOT_SEGMENT = r"/\.\.?(/|$)"
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'\s>]*)"""


def url_host(url):
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for a null url or one without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url):
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def without_dots(path):
    """A path without its ``.`` and ``..`` segments (RFC 3986, 5.2.4)."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"),
        lambda out, s: F.when(s == ".", out).when(s == "..", F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))))
        .otherwise(F.concat(out, F.array(s))))
    open_end = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.when(F.rlike(path, F.lit(DOT_SEGMENT)), F.concat(F.lit("/"), F.array_join(F.concat(kept, open_end), "/"))).otherwise(path)


def url_key(url):
    """Node of a URL in the link graph: the URL without its fragment and its
    path's dot segments, host in lower case."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)?", 1)
    return F.when(F.contains(url, F.lit("://")),
                  F.concat(scheme, F.lit("://"), url_host(url), without_dots(url_path(url)), query))


def best_rule(host, path, rules=RULES):
    """Struct ``(rule, kind)`` of the longest fitting rule, or null. Two rules
    of one length that fit one url are the same rule or differ in nothing but
    the split of host and path; the first given wins."""
    out = F.lit(None).cast("struct<rule:string,kind:string>")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(kind).alias("kind"))).otherwise(out)
    return out


def resolve(base, href):
    """Absolute form of a link: absolute (with a scheme before its first ``://``)
    as it is, ``//host/..`` with the base's scheme, ``/path`` on the base's host,
    ``?query`` on the base's path, ``#fragment`` the base, else beside the
    base's path. Dot segments are left to ``url_key``."""
    href = F.replace(F.trim(href), F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), url_host(base))
    folder = F.regexp_replace(url_path(base), r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (F.when(href == "", F.lit(None).cast("string"))
            .when(F.rlike(href, F.lit(ABSOLUTE)), href)
            .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
            .when(F.startswith(href, F.lit("/")), F.concat(root, href))
            .when(F.startswith(href, F.lit("?")), F.concat(root, url_path(base), href))
            .when(F.startswith(href, F.lit("#")), base)
            .otherwise(F.concat(root, folder, href)))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Alias edges ``(src, dst)`` of pages: the target of ``<link
    rel=canonical>`` and of ``<meta http-equiv=refresh>``, resolved against the
    page's url. Pages with a null url, or without such a tag, give none."""
    u, h = F.col(url_col), F.col(html_col)
    tags = pages.where(u.isNotNull() & h.isNotNull() & F.rlike(h, F.lit(f"{CANONICAL}|{REFRESH}"))).select(
        u.alias("u"), F.explode(F.array(
            F.regexp_extract(F.regexp_extract(h, CANONICAL, 0), HREF, 1),
            F.regexp_extract(F.regexp_extract(h, REFRESH, 0), REFRESH_URL, 1))).alias("href"))
    return (tags.select(url_key(F.col("u")).alias("src"), url_key(resolve(F.col("u"), F.col("href"))).alias("dst"))
            .where("src IS NOT NULL AND dst IS NOT NULL AND src != dst"))


def filter_urls(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None,
                url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` with the columns ``host, path, rule, verdict`` added (columns
    of these names in the input are replaced).

    ``redirects``: further alias edges ``(src, dst)`` of absolute URLs, such as
    a crawler's redirect log. A page's verdict is its own rule's; without one,
    ``block`` when a URL of its class is blocked by a rule, else ``allow``. A
    class that holds both explicitly allowed and blocked URLs blocks its
    members without a rule; those with an allow rule stay allowed.

    Null url: empty host and path, no rule, ``allow``. Repeated rows are
    judged each. An empty table gives an empty result.

    Only linked URLs (the edge table) enter the component rounds; the page
    table itself is scanned for links and joined once with the blocked nodes.
    """
    tables = Tables(pages.sparkSession, "urls")
    links = page_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select(
            url_key(F.col("src")).alias("src"), url_key(F.col("dst")).alias("dst")).where("src != dst"))
    edges = tables.save(links.distinct().select(F.col("src").alias("a"), F.col("dst").alias("b")), "links")
    u = F.col(url_col)
    node, verdict, best = (free_name(pages, n) for n in ("node", "blocked", "best"))
    drop = [c for c in pages.columns if c.lower() in ("host", "path", "rule", "verdict") and c != url_col]
    out = pages.drop(*drop).select(
        "*", url_host(u).alias("host"), url_path(u).alias("path")).withColumn(best, best_rule(F.col("host"), F.col("path"), rules))
    alias_block = F.lit(False)
    if not edges.isEmpty():
        comp = components(edges, tables)
        kind = best_rule(url_host(F.col("id")), url_path(F.col("id")), rules)["kind"]
        bad = comp.groupBy("component").agg(F.max(F.coalesce(kind == "block", F.lit(False))).alias(verdict)).where(verdict)
        blocked = tables.save(comp.join(bad, "component").select(F.col("id").alias(node), verdict), "blocked")
        out = out.withColumn(node, url_key(u)).join(blocked, node, "left")
        alias_block = F.coalesce(F.col(verdict), F.lit(False))
    kind = F.col(best)["kind"]
    return (out.withColumn("rule", F.col(best)["rule"])
            .withColumn("verdict", F.when(kind.isNotNull(), kind).when(alias_block, "block").otherwise("allow"))
            .drop(best, node, verdict))
