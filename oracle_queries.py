"""DuckDB SQL for every registered query, written independently of the Spark
code: row-level window functions instead of arg-min aggregates, a recursive
CTE for the similarity ratio, brute-force pair enumeration for candidates.
Tables ``pages customer orders`` are pre-registered views."""

from __future__ import annotations

# Fixed values, written out here so that a wrong table in the engine shows: white
# space that name and text stripping removes, corporate suffix words, and the
# character references that the pages and fixtures hold ('&amp;' last).
WS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
SUFFIX_PATTERN = r"\b(pty|pvt|ltd|plc|inc|co|company|limited|llc|corporation|corp)\b"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"),
            ("&euro;", "\u20ac"), ("&ntilde;", "\u00f1"), ("&#8364;", "\u20ac"), ("&#x41;", "A"), ("&amp;", "&"))


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{WS}+|{WS}+\z', '', 'g')"


def decode(x: str) -> str:
    out = x
    for ent, ch in ENTITIES:
        out = f"replace({out}, '{ent}', chr({ord(ch)}))"
    return out


def domain(u: str) -> str:
    cleaned = rf"regexp_replace(regexp_replace({u}, '[\t\r\n]', '', 'g'), '^[\x00-\x20]+', '')"
    n = rf"regexp_extract({cleaned}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)"
    bracket_ok = (rf"regexp_matches({n}, '^[^\[\]]*\[(v[0-9A-Fa-f]+\.[^\[\]]+|[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*"
                  rf"(%[^\[\]]+)?)\](:[^\[\]]*)?$')")
    return (f"(CASE WHEN contains({n}, '[') <> contains({n}, ']') THEN NULL "
            f"WHEN (contains({n}, '[') OR contains({n}, ']')) AND NOT {bracket_ok} THEN NULL ELSE lower({n}) END)")


def norm(x: str) -> str:
    s = f"lower({x})"
    for pat, rep in (
        (r"\([^)]*\)", " "),
        (r"[^\p{L}\p{N}_\x00-\x7F]", " "),
        (r"[^\x00-\x7F]", "_"),
        (SUFFIX_PATTERN, " "),
        (r"[^a-z0-9& ]", " "),
        (r" +", " "),
    ):
        s = f"regexp_replace({s}, '{pat}', '{rep}', 'g')"
    return f"nullif(trim({s}), '')"


TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"


def title_name(h: str) -> str:
    return strip(f"split_part({decode(f'nullif(regexp_extract({h}, {q(TITLE)}, 1), {q()})')}, '|', 1)")


def q(s: str = "") -> str:
    return "'" + s.replace("'", "''") + "'"


STATES = "['NSW','VIC','QLD','WA','SA','TAS','ACT','NT']"

CC = f"""cc AS (
  SELECT page_id, url, {domain('url')} AS domain, {title_name('html')} AS extracted_name,
         CASE WHEN page_id % 4 = 3 THEN NULL ELSE ['Mining','Retail','Finance'][page_id % 3 + 1] END
           AS extracted_industry
  FROM pages)"""

REG = f"""reg AS (
  SELECT page_id,
         CASE WHEN page_id % 10 = 6 THEN NULL ELSE CAST(10000000000 + page_id AS VARCHAR) END AS abn,
         CASE page_id % 4
           WHEN 0 THEN extracted_name || ' Pty Ltd'
           WHEN 1 THEN left(extracted_name, greatest(length(extracted_name) - 2, 0))
           WHEN 2 THEN left(extracted_name, CAST(floor(length(extracted_name) * 0.75) AS INTEGER))
           ELSE reverse(extracted_name) END AS entity_name,
         CASE page_id % 3 WHEN 0 THEN 'Australian Private Company' WHEN 1 THEN 'Sole Trader' END
           AS entity_type,
         'Unit ' || CAST(page_id AS VARCHAR) || ' Example Street' AS address,
         lpad(CAST(page_id % 9000 AS VARCHAR), 4, '0') AS postcode,
         {STATES}[page_id % 8 + 1] AS state
  FROM cc)"""

OVERLAP = (
    "list_sum(list_transform(list_distinct(string_split(r.norm, '')), lambda ch: "
    "least(length(r.norm) - length(replace(r.norm, ch, '')), "
    "length(c.norm) - length(replace(c.norm, ch, '')))))"
)

MATCH = f"""{CC},
{REG},
reg_rows AS (SELECT * FROM (SELECT abn, entity_name, entity_type, address, postcode, state,
                                   {norm('entity_name')} AS norm FROM reg) WHERE norm IS NOT NULL),
crawl_rows AS (SELECT * FROM (SELECT domain, extracted_industry, {norm('extracted_name')} AS norm FROM cc)
               WHERE norm IS NOT NULL),
rn AS (SELECT DISTINCT norm FROM reg_rows),
cn AS (SELECT DISTINCT norm FROM crawl_rows),
exact_pairs AS (SELECT norm AS r_norm, norm AS c_norm FROM rn JOIN cn USING (norm)),
block_pairs AS (
  SELECT r.norm AS r_norm, c.norm AS c_norm, CAST(length(r.norm) AS INTEGER) AS r_len,
         CAST(length(c.norm) AS INTEGER) AS c_len, CAST({OVERLAP} AS INTEGER) AS overlap
  FROM rn r JOIN cn c ON substring(r.norm, 1, 3) = substring(c.norm, 1, 3) AND r.norm <> c.norm),
cands AS (
  SELECT * FROM block_pairs
  WHERE 2.0::DOUBLE * least(r_len, c_len) / (r_len + c_len) >= 0.8::DOUBLE
    AND 2.0::DOUBLE * overlap / (r_len + c_len) >= 0.8::DOUBLE),
page_names AS (
  SELECT DISTINCT {norm('entity_name')} AS r_norm, {norm('extracted_name')} AS c_norm FROM reg JOIN cc USING (page_id)),
p AS (SELECT row_number() OVER () AS pid, r_norm AS a, c_norm AS b FROM cands),
"""

# a verdict exists for the two names of a page; any yes counts
CONFIRMED = ("length(s.r_norm) % 3 = 0 AND EXISTS "
             "(SELECT 1 FROM page_names n WHERE n.r_norm = s.r_norm AND n.c_norm = s.c_norm)")

SEG = """seg(pid, a, b, m) AS (
  SELECT pid, a, b, 0 FROM p
  UNION ALL
  SELECT pid, x.a, x.b, x.m FROM (
    SELECT pid, unnest([
      {'a': a[:bst.i-1],     'b': b[:instr(b, bst.s)-1],     'm': bst.l},
      {'a': a[bst.i+bst.l:], 'b': b[instr(b, bst.s)+bst.l:], 'm': 0}]) AS x
    FROM (SELECT pid, a, b, list_max(list_filter(flatten(
            list_transform(range(1, length(a)+1), lambda i:
              list_transform(range(1, length(a)-i+2), lambda l:
                {'l': l, 'n': -i, 'i': i, 's': a[i:i+l-1]}))),
            lambda t: contains(b, t.s))) AS bst
          FROM seg WHERE length(a) > 0 AND length(b) > 0)
    WHERE bst IS NOT NULL)),
"""

SCORED = """ratios AS (
  SELECT p.a AS r_norm, p.b AS c_norm, 2.0::DOUBLE * s.m / (length(p.a) + length(p.b)) AS fuzzy_score
  FROM p JOIN (SELECT pid, sum(m) AS m FROM seg GROUP BY pid) s USING (pid)),
scored AS (SELECT * FROM ratios WHERE fuzzy_score >= 0.8::DOUBLE)"""

MATCH_CTES = "WITH RECURSIVE " + MATCH + SEG + SCORED


def unified_sql(with_verdicts: bool, exact_only: bool = False) -> str:
    confirmed_case = f"WHEN {CONFIRMED} THEN 'FUZZY_LLM'" if with_verdicts else ""
    fuzzy = "" if exact_only else f"""
    UNION ALL
    SELECT * FROM (SELECT r_norm, c_norm, fuzzy_score,
                          CASE WHEN fuzzy_score >= 0.95::DOUBLE THEN 'FUZZY_HIGH' {confirmed_case} END AS match_type
                   FROM scored s) WHERE match_type IS NOT NULL"""
    return MATCH_CTES + f""",
pairs AS (
    SELECT r_norm, c_norm, 1.0::DOUBLE AS fuzzy_score, 'EXACT' AS match_type FROM exact_pairs{fuzzy}),
rows AS (
  SELECT r.abn, r.entity_name, r.entity_type, r.address, r.postcode, r.state, c.domain,
         c.extracted_industry, p.match_type, p.fuzzy_score,
         CASE p.match_type WHEN 'EXACT' THEN 3 WHEN 'FUZZY_LLM' THEN 2 WHEN 'FUZZY_HIGH' THEN 1 ELSE 0 END AS prec
  FROM pairs p JOIN reg_rows r ON r.norm = p.r_norm JOIN crawl_rows c ON c.norm = p.c_norm
  WHERE NOT (p.match_type = 'FUZZY_LLM' AND r.abn IS NULL)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY abn, domain ORDER BY prec DESC, fuzzy_score DESC,
      entity_name ASC NULLS FIRST, entity_type ASC NULLS FIRST, address ASC NULLS FIRST,
      postcode ASC NULLS FIRST, state ASC NULLS FIRST, extracted_industry ASC NULLS FIRST) AS rk
  FROM rows)
SELECT abn, entity_name, entity_type, address, postcode, state, domain, extracted_industry, match_type
FROM ranked WHERE rk = 1"""


# --- pages, hits ---------------------------------------------------------------

NOISE = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
CONTENT = (
    "({d})".format(d=decode(
        r"""regexp_extract({t}, '(?is)\scontent\s*=\s*"([^"]*)"', 1) || """
        r"""regexp_extract({t}, '(?is)\scontent\s*=\s*''([^'']*)''', 1) || """
        r"""regexp_extract({t}, '(?is)\scontent\s*=\s*([^\s"''>]+)', 1)"""
    ))
)


def meta_tag(h: str, attr: str, value: str) -> str:
    return rf"""regexp_extract({h}, '(?is)<meta\s[^>]*{attr}\s*=\s*["'']?{value}["''\s/>][^>]*>', 0)"""


def content(tag: str) -> str:
    return CONTENT.replace("{t}", tag)


def fetched_pages() -> str:
    snippet = """CASE page_id % 5
      WHEN 1 THEN '<meta property="og:site_name" content="Site &euro;&ntilde; &#8364;&#x41; &amp;lt; ' || CAST(page_id AS VARCHAR) || '">'
      WHEN 2 THEN '<meta property="og:site_name" content=""><meta property="og:title" content="X">'
      WHEN 3 THEN '<div itemtype="https://schema.org/Organization"><span itemprop="name"> Org '
                  || CAST(page_id AS VARCHAR) || ' </span></div>'
      WHEN 4 THEN '<meta name="keywords" content=" mining, gold"><meta name="industry" content="Retail">'
      ELSE '' END"""
    return f"""fp AS (
  SELECT page_id, url,
         CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 7 = 0 THEN 404 ELSE 200 END AS http_status,
         CASE WHEN page_id % 11 = 0 THEN NULL ELSE {snippet} || html END AS html
  FROM pages)"""


def page_fields_cte(src: str = "fp") -> str:
    site = meta_tag("clean", "property", "og:site_name")
    ogt = meta_tag("clean", "property", "og:title")
    kw = content(meta_tag("clean", "name", "keywords"))
    ind = content(meta_tag("clean", "name", "industry"))
    org_rest = r"""regexp_extract(clean, '(?is)<[a-z][a-z0-9:_-]*\s[^>]*itemtype\s*=\s*["'']?[^"''>]*schema.org/Organization[^>]*>(.*)$', 1)"""
    inner = rf"""regexp_extract({org_rest}, '(?is)<[a-z][a-z0-9:_-]*\s[^>]*itemprop\s*=\s*["'']?name["''\s/>][^>]*>(.*?)</', 1)"""
    org = f"nullif(array_to_string(list_transform(regexp_split_to_array({inner}, '<[^>]*>'), lambda t: {strip(decode('t'))}), ''), '')"
    meta_content = content(f"(CASE WHEN {site} <> '' THEN {site} ELSE {ogt} END)")
    return f"""b AS (SELECT *, CASE WHEN http_status = 200 THEN html END AS body FROM {src}),
c AS (SELECT *, regexp_replace(body, '{NOISE}', ' ', 'g') AS clean FROM b),
m AS (SELECT *, {org} AS org_name,
             CASE WHEN {meta_content} <> '' THEN {strip(meta_content)} END AS meta_name,
             {title_name('clean')} AS title,
             CASE WHEN {kw} <> '' THEN {strip(f"split_part({kw}, ',', 1)")} END AS kw_first,
             CASE WHEN {ind} <> '' THEN {strip(ind)} END AS ind_val
      FROM c),
f AS (SELECT *,
        CASE WHEN body IS NOT NULL AND body <> '' THEN coalesce(org_name, nullif(meta_name, ''), title, meta_name) END
          AS extracted_name,
        CASE WHEN body IS NOT NULL AND body <> '' THEN coalesce(nullif(kw_first, ''), ind_val, kw_first) END
          AS extracted_industry,
        CASE WHEN length(body) > 0 AND length(body) < 200000 THEN body END AS raw_html
      FROM m)"""


def hit_lines() -> str:
    meta = """'"length":' || CAST(length(html) AS VARCHAR) || ',"mime":"text/html"'"""
    return f"""lines AS (
  SELECT page_id * 10 + k AS line_no, value FROM (
    SELECT page_id, 0 AS k, CASE
        WHEN page_id % 17 = 0 THEN '{{' || {meta} || ',"status":"200"}}'
        WHEN page_id % 2 = 0 THEN '{{' || {meta} || ',"status":"200","url":"' || url || '"}}'
        ELSE '{{' || {meta} || ',"original":"' || url || '","status":"200"}}' END AS value FROM pages
    UNION ALL SELECT page_id, 1, CASE WHEN page_id % 9 = 0 THEN
        '{{"length":0,"mime":"text/html","status":"200","url":"' || url || '"}}' END FROM pages
    UNION ALL SELECT page_id, 2, CASE WHEN page_id % 13 = 0 THEN
        '{{' || {meta} || ',"status":"200","url":"' || url || '?nofetch=1"}}' END FROM pages
    UNION ALL SELECT page_id, 3, CASE WHEN page_id % 19 = 0 THEN '{{"url": "' || url END FROM pages
    UNION ALL SELECT page_id, 4, CASE WHEN page_id % 23 = 0 THEN '' END FROM pages
    UNION ALL SELECT page_id, 5, CASE WHEN page_id % 29 = 0 THEN '["' || url || '"]' END FROM pages)
  WHERE value IS NOT NULL),
hits AS (
  SELECT line_no, value, url FROM (
    SELECT line_no, value, coalesce(nullif(json_extract_string(value, '$.url'), ''),
                                    json_extract_string(value, '$.original')) AS url
    FROM lines WHERE regexp_matches(value, '^\\s*\\{{') AND json_valid(value))
  WHERE url IS NOT NULL AND url <> '')"""


def crawl_stage_sql() -> str:
    return f"""WITH {fetched_pages()},
{hit_lines()},
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sha256(url) ORDER BY line_no) AS rk FROM hits)
  WHERE rk = 1),
src AS (SELECT h.line_no, h.url AS source_url, h.value, fp.http_status, fp.html
        FROM firsts h LEFT JOIN fp ON fp.url = h.url),
{page_fields_cte('src')}
SELECT line_no, source_url, CASE WHEN source_url <> '' THEN sha256(source_url) END AS url_hash,
       {domain('source_url')} AS domain, extracted_name, extracted_industry,
       CAST(http_status AS INTEGER) AS http_status, raw_html, '{{"cc_index":' || value || '}}' AS extra
FROM f"""


# --- registry ----------------------------------------------------------------

REGISTRY_BASE = f"""recs AS (
  SELECT c_custkey AS k, c_custkey % 6 AS v,
         c_custkey % 50 = 7 AS ns,
         c_custkey % 50 = 19 AND c_custkey % 6 <> 4 AS malformed,
         CASE WHEN c_custkey % 6 = 5 THEN lpad(CAST(c_custkey - 5 AS VARCHAR), 11, '0')
              ELSE lpad(CAST(c_custkey AS VARCHAR), 11, '0') END AS abn_v,
         c_name AS name, c_mktsegment AS etype,
         CASE WHEN c_acctbal >= 0 THEN 'ACT' ELSE 'CAN' END AS status,
         'Level ' || CAST(c_nationkey AS VARCHAR) || ' Market St' AS addr,
         lpad(CAST(c_nationkey * 100 AS VARCHAR), 4, '0') AS pc,
         {STATES}[c_nationkey % 8 + 1] AS st,
         DATE '1990-01-01' + CAST((c_custkey * 37) % 10000 AS INTEGER) AS day
  FROM customer),
flat AS (
  SELECT k,
    CASE WHEN ns OR v NOT IN (3, 4) THEN abn_v END AS abn,
    CASE WHEN v = 4 AND NOT ns THEN NULL ELSE name END AS entity_name,
    etype AS entity_type,
    CASE WHEN ns OR v IN (2, 3) THEN NULL ELSE status END AS entity_status,
    CASE WHEN ns OR v IN (2, 3, 4) THEN NULL ELSE addr END AS address,
    CASE WHEN ns THEN pc WHEN v = 2 THEN '' WHEN v = 4 THEN NULL ELSE pc END AS postcode,
    st AS state,
    CASE WHEN ns OR v IN (3, 4) THEN NULL ELSE day END AS start_date,
    CASE WHEN malformed AND NOT ns THEN 'parse_failed'
         WHEN v = 4 AND NOT ns THEN 'missing_key_fields' END AS reason
  FROM recs)"""


def registry_flatten_sql() -> str:
    return f"""WITH {REGISTRY_BASE},
good AS (SELECT * FROM flat WHERE reason IS NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY abn ORDER BY k) AS rk FROM good)
SELECT k AS c_custkey, abn, entity_name, entity_type, entity_status, address, postcode, state, start_date
FROM ranked WHERE rk = 1 OR abn IS NULL"""


def registry_quarantine_sql() -> str:
    return f"""WITH {REGISTRY_BASE}
SELECT k AS c_custkey, reason FROM flat WHERE reason IS NOT NULL"""


XML_SCAN = f"""SELECT abn,
  CASE v WHEN 1 THEN 'A&B ' || name WHEN 4 THEN NULL ELSE name END AS entity_name,
  CAST(NULL AS VARCHAR) AS entity_status,
  CASE WHEN v IN (0, 4) THEN pc END AS postcode,
  CASE WHEN v IN (0, 2) THEN st END AS state,
  false AS parse_failed
FROM (SELECT c_custkey % 6 AS v, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS abn, c_name AS name,
             lpad(CAST(c_nationkey * 100 AS VARCHAR), 4, '0') AS pc, {STATES}[c_nationkey % 8 + 1] AS st FROM customer)"""


# --- assembled -------------------------------------------------------------

def _names_sql() -> str:
    return f"""WITH {CC},
{REG},
names AS (
  SELECT 'crawl' AS source, page_id AS id, extracted_name AS name FROM cc
  UNION ALL SELECT 'registry', page_id, entity_name FROM reg
  UNION ALL SELECT 'customer', c_custkey, c_name FROM customer)
SELECT source, id, name, {norm('name')} AS norm_name, substring({norm('name')}, 1, 3) AS block_key FROM names"""


def _dates_sql() -> str:
    return """SELECT o_orderkey, raw,
       CASE WHEN o_orderkey % 9 IN (4, 5) THEN NULL ELSE CAST(o_orderdate AS DATE) END AS start_date
FROM (SELECT o_orderkey, o_orderdate, CASE o_orderkey % 9
        WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || 'Z'
        WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T01:30:00+10:00'
        WHEN 3 THEN strftime(o_orderdate, '%Y%m%d')
        WHEN 4 THEN '  '
        WHEN 5 THEN 'junk'
        WHEN 6 THEN strftime(o_orderdate, '%-m/%-d/%Y')
        WHEN 7 THEN strftime(o_orderdate, '%-d %B %Y')
        ELSE strftime(o_orderdate, '%B %-d, %Y') END AS raw
      FROM orders)"""


def _load_metrics_sql() -> str:
    hits = f"""WITH {fetched_pages()}, {hit_lines()}
SELECT count(*) FROM hits"""
    crawl = f"""WITH {fetched_pages()}, {hit_lines()}
SELECT count(DISTINCT sha256(url)) FROM hits"""
    unified = unified_sql(True)
    return f"""WITH reg_q AS ({registry_quarantine_sql()}),
reg_i AS ({registry_flatten_sql()}),
uni AS ({unified})
SELECT 'registry_parsed' AS metric, (SELECT count(*) FROM customer) AS value
UNION ALL SELECT 'registry_quarantined', (SELECT count(*) FROM reg_q)
UNION ALL SELECT 'registry_inserted', (SELECT count(*) FROM reg_i)
UNION ALL SELECT 'crawl_hits', ({hits})
UNION ALL SELECT 'crawl_inserted', ({crawl})
UNION ALL SELECT 'unified_rows', (SELECT count(*) FROM uni)
UNION ALL SELECT 'unified_exact', (SELECT count(*) FROM uni WHERE match_type = 'EXACT')
UNION ALL SELECT 'unified_fuzzy_high', (SELECT count(*) FROM uni WHERE match_type = 'FUZZY_HIGH')
UNION ALL SELECT 'unified_fuzzy_llm', (SELECT count(*) FROM uni WHERE match_type = 'FUZZY_LLM')"""


def oracle_sql() -> dict[str, str]:
    return {
        "normalize_names": _names_sql(),
        "url_domain_hash": f"""SELECT page_id, url, {domain('url')} AS domain,
       CASE WHEN url <> '' THEN sha256(url) END AS url_hash,
       sha256(concat_ws('|', url, {domain('url')}, CAST(page_id AS VARCHAR))) AS row_hash
FROM pages""",
        "page_company_fields": f"""WITH {fetched_pages()},
{page_fields_cte('fp')}
SELECT page_id, url, {domain('url')} AS domain, http_status, extracted_name, extracted_industry,
       CAST(length(raw_html) AS INTEGER) AS raw_html_chars
FROM f""",
        "index_hits_stage": crawl_stage_sql(),
        "exact_match": unified_sql(False, exact_only=True),
        "block_candidates": MATCH_CTES + "\nSELECT r_norm, c_norm, r_len, c_len, overlap FROM cands",
        "fuzzy_scores": MATCH_CTES + "\nSELECT r_norm, c_norm, fuzzy_score FROM scored",
        "match_bands": MATCH_CTES + """,
bp AS (SELECT r_norm, c_norm, 'EXACT' AS band FROM exact_pairs
       UNION ALL SELECT r_norm, c_norm, CASE WHEN fuzzy_score >= 0.95::DOUBLE THEN 'HIGH' ELSE 'BORDERLINE' END
       FROM scored),
rc AS (SELECT norm AS r_norm, count(*) AS rows_r FROM reg_rows GROUP BY norm),
cc2 AS (SELECT norm AS c_norm, count(*) AS rows_c FROM crawl_rows GROUP BY norm)
SELECT band, count(*) AS name_pairs, CAST(sum(rows_r * rows_c) AS BIGINT) AS row_pairs
FROM bp JOIN rc USING (r_norm) JOIN cc2 USING (c_norm) GROUP BY band""",
        "confirmed_pairs": MATCH_CTES + """
SELECT r_norm AS reg_norm, c_norm AS crawl_norm, fuzzy_score FROM scored s
WHERE fuzzy_score < 0.95::DOUBLE AND """ + CONFIRMED,
        "confirmed_by_function": MATCH_CTES + """
SELECT r_norm AS reg_norm, c_norm AS crawl_norm, fuzzy_score FROM scored
WHERE fuzzy_score < 0.95::DOUBLE AND length(r_norm) % 3 = 0""",
        "registry_xml_scan": XML_SCAN,
        "quarantine_sink": f"""WITH {REGISTRY_BASE}
SELECT reason AS error, reason, abn, state FROM flat WHERE reason IS NOT NULL""",
        "rerun_loads": f"""WITH c AS ({crawl_stage_sql()}), u AS ({unified_sql(True)})
SELECT 'crawl' AS kind, 1 AS load, url_hash AS key, domain, extracted_name AS value FROM c
UNION ALL SELECT 'unified', 1, abn, domain, match_type FROM u""",
        "unify_no_verdicts": unified_sql(False),
        "unify": unified_sql(True),
        "keep_first_load": f"""SELECT domain, page_id, url FROM (
  SELECT {domain('url')} AS domain, page_id, url,
         row_number() OVER (PARTITION BY {domain('url')} ORDER BY page_id) AS rk FROM pages)
WHERE rk = 1 OR domain IS NULL""",
        "insert_if_absent": f"""WITH r AS (SELECT {domain('url')} AS key, page_id, url FROM pages),
l1 AS (SELECT key, page_id, url FROM (
         SELECT *, row_number() OVER (PARTITION BY key ORDER BY page_id) AS rk FROM r)
       WHERE rk = 1 OR key IS NULL),
b2 AS (SELECT CASE WHEN page_id % 10 = 0 THEN NULL
                   ELSE regexp_replace(key, '^(www|m|blog)\\.', '') END AS key, page_id, url FROM r),
f2 AS (SELECT key, page_id, url FROM (
         SELECT *, row_number() OVER (PARTITION BY key ORDER BY page_id) AS rk FROM b2)
       WHERE rk = 1 OR key IS NULL),
l2 AS (SELECT * FROM f2 WHERE key IS NULL OR key NOT IN (SELECT key FROM l1 WHERE key IS NOT NULL))
SELECT key, page_id, url, 1 AS load FROM l1 UNION ALL SELECT key, page_id, url, 2 AS load FROM l2""",
        "registry_flatten": registry_flatten_sql(),
        "registry_quarantine": registry_quarantine_sql(),
        "date_normalize": _dates_sql(),
        "load_metrics": _load_metrics_sql(),
        "table_roundtrip": "SELECT * FROM customer",
    }
