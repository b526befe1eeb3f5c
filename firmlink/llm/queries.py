"""The registered queries ``opN_*``: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlink.llm import (
    decontaminate,
    lang_id,
    line_dedup,
    lm_score,
    mixing,
    packing,
    prefix_trie,
    simhash,
    spelling,
    substring,
    topk,
    toxicity,
)
from firmlink.llm.url_filter import filter_urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=1024).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs, window=20).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(rows, rows.where("vec_id % 100 = 0"), k=10, scale=1024)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", lang_id.held_out_fold())
    model = lang_id.train(docs.where("NOT held_out"))
    return lang_id.identify(docs, model).select("doc_id", "held_out", "lang_pred", "score")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"), order=3, alpha=0.4)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13)
    return judged.select("doc_id", "n_words", "n_hit", "n_items",
                         F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", toxicity.held_out_fold())
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    net = toxicity.train(docs.where("NOT held_out").join(labels, "doc_id"))
    return toxicity.score(docs, net).select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), max_repeats=3)
    return mixing.by_position(mixed).select("doc_id", "size", "source_size", "target", "taken", "position")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_packing": op2_packing,
    "op3_substring": op3_substring,
    "op4_url_filters": op4_url_filters,
    "op5_topk": op5_topk,
    "op6_language_id": op6_language_id,
    "op7_simhash": op7_simhash,
    "op8_lm_score": op8_lm_score,
    "op9_decontamination": op9_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_mixing": op11_mixing,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling": op13_spelling,
}

ORACLES = {
    "op5_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, r.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id % 100 = 0 AND r.vec_id <> q.vec_id AND len(q.e) = len(r.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
""",
    "op4_url_filters": r"""
WITH RECURSIVE
rules(kind, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                                     ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
p AS (
  SELECT row_number() OVER () AS n, page_id, url, html,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
tags AS (
  SELECT url, host, path, unnest([
    regexp_extract(regexp_extract(html, '<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0, 'is'),
                   '\bhref\s*=\s*["'']?([^"''\s>]*)', 1, 'is'),
    regexp_extract(regexp_extract(html, '<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0, 'is'),
                   '\burl\s*=\s*["'']?([^"''\s>]*)', 1, 'is')]) AS href0
  FROM p WHERE url IS NOT NULL AND html IS NOT NULL),
hrefs AS (
  SELECT *, replace(trim(href0), '&amp;', '&') AS href, regexp_extract(url, '^(.*?)://', 1, 's') AS scheme,
         CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END AS folder
  FROM tags WHERE trim(href0) <> ''),
targets AS (
  SELECT url AS src, CASE WHEN contains(href, '://') THEN href
              WHEN starts_with(href, '//') THEN scheme || ':' || href
              WHEN starts_with(href, '/') THEN scheme || '://' || host || href
              ELSE scheme || '://' || host || folder || href END AS dst
  FROM hrefs),
urls AS (SELECT url AS u FROM p WHERE contains(url, '://')
         UNION SELECT src FROM targets UNION SELECT dst FROM targets),
nodes AS (
  SELECT u, regexp_extract(u, '^(.*?)://', 1, 's') || '://' || h || pa
            || regexp_extract(u, '^.*?://[^?#]*(\?[^#]*)?', 1, 's') AS node, h, pa
  FROM (SELECT u, translate(regexp_extract(u, '^.*?://([^/?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h,
               regexp_extract(u, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS pa
        FROM urls WHERE contains(u, '://')) x),
edges AS (
  SELECT DISTINCT a.node AS a, b.node AS b FROM targets t JOIN nodes a ON a.u = t.src JOIN nodes b ON b.u = t.dst
  WHERE a.node <> b.node),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
ruled AS (
  SELECT n.node, arg_max(kind, length(rhost || rpath)) AS kind
  FROM nodes n JOIN rules ON (n.h = rhost OR ends_with(n.h, '.' || rhost)) AND starts_with(n.pa, rpath)
  GROUP BY n.node),
reach(node) AS (
  SELECT node FROM ruled WHERE kind = 'block'
  UNION SELECT e.b FROM reach r JOIN both_ways e ON e.a = r.node),
own AS (
  SELECT p.n, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(kind, length(rhost || rpath)) AS kind
  FROM p JOIN rules ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath)
  GROUP BY p.n)
SELECT p.page_id, p.host, p.path, own.rule,
       CASE WHEN own.kind IS NOT NULL THEN own.kind
            WHEN p.url IN (SELECT n.u FROM nodes n JOIN reach r ON r.node = n.node) THEN 'block'
            ELSE 'allow' END AS verdict
FROM p LEFT JOIN own ON own.n = p.n
""",
    "op11_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (
  SELECT *, CAST(1 + (k - 1) % 3 AS DOUBLE) AS w, CASE WHEN k % 2 = 1 THEN 0.5 ELSE -0.5 END AS tilt, 3 * source_size AS cap
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k
        FROM d GROUP BY source)),
f AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER below, 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER below, 0) AS over_w
  FROM s WINDOW below AS (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT *, cap * over_w > w * rest AS open FROM f),
t AS (
  SELECT o.*, CASE WHEN open THEN least(CAST(m.rest AS DOUBLE) * (w / m.over_w), CAST(cap AS DOUBLE)) ELSE CAST(cap AS DOUBLE) END AS target
  FROM o LEFT JOIN (SELECT rest, over_w FROM o WHERE open ORDER BY cap / w, k LIMIT 1) m ON true),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.w, t.tilt, CAST(round(t.target) AS BIGINT) AS take,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('0:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), d.size
                                ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS start
  FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source),
q AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE
           take // source_size * size + greatest(least(take % source_size - start, size), 0) END AS taken,
         start / nullif(CAST(take AS DOUBLE), 0) * w AS want, w * (1 - tilt) AS w0, w * (1 + tilt) AS w2
  FROM p),
h AS (
  SELECT *, 0.5 * (w0 + w) / 2 AS half FROM q),
z AS (
  SELECT *, want < half AS early, CASE WHEN want < half THEN want ELSE want - half END AS y,
         CASE WHEN want < half THEN w0 ELSE w END AS wa, CASE WHEN want < half THEN w ELSE w2 END AS wb
  FROM h)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN (CASE WHEN early THEN 0.0 ELSE 0.5 END)
         + y * 2 / (wa + sqrt(greatest(wa * wa + (wb - wa) / 0.5 * y * 2, 0.0))) END AS position
FROM z
""",
}
