"""Benchmark decontamination with a distributed positional inverted index.

The corpus is indexed in shards: a shard holds some documents whole, and for
each of its terms the sorted list of positions where it occurs (positions run
through the shard, with a gap between documents). The index is a table, one row
for each shard, so building and searching are maps over shards without a
shuffle, and more executors shorten both.

A search takes the test phrases (windows of an item's words). In each shard it
starts from a phrase's rarest term (by counts over the whole corpus), shifts its
positions by the term's offset to phrase starts, and intersects them with the
shifted lists of the other terms, rarest first, until none is left or all terms
agree. With ``slop`` > 0 it returns proximity matches: each term may lie up to
``slop`` words from its place.

Terms are held as 64-bit hashes (SipHash); two terms of one hash would be taken
for one another.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlink.llm.common import Tables, free_name

WINDOW = 13
SHARD_BYTES = 4 << 20
#: Test items are sent to the tasks in blocks of up to so many bytes of text.
BLOCK_BYTES = 8 << 20

# Word characters are digits, a-z (A-Z lower-cased) and every
# byte of a non-ASCII character; the rest separates words.
_TO = bytes(b if b in range(0x30, 0x3A) or b in range(0x61, 0x7B) or b >= 0x80 else b + 32 if b in range(0x41, 0x5B) else 0x20
            for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TO).split() if text else []


def hashed(words) -> np.ndarray:
    a = np.empty(len(words), dtype=object)
    a[:] = words
    return pd.util.hash_array(a, categorize=False) if len(words) else np.zeros(0, np.uint64)


INDEX_SCHEMA = ("shard string, doc_keys array<string>, n_words binary, terms binary, counts binary, positions binary")


def _shard(shard: str, keys: list, texts: list) -> dict:
    docs = [words_of(t) for t in texts]
    n = np.array([len(d) for d in docs], np.int64)
    flat = np.empty(n.sum(), dtype=object)
    flat[:] = [w for d in docs for w in d]
    codes, uniques = pd.factorize(flat) if len(flat) else (np.zeros(0, np.int64), np.zeros(0, object))
    base = np.cumsum(n + 1) - (n + 1)
    pos = (np.arange(len(flat)) + np.repeat(np.arange(len(n)), n)).astype(np.uint32)
    assert not len(n) or base[-1] + n[-1] < 1 << 32
    h = hashed(uniques)
    rank = np.empty(len(h), np.int32)
    by_hash = np.argsort(h)
    rank[by_hash] = np.arange(len(h), dtype=np.int32)
    code = rank[codes]
    order = np.argsort(code, kind="stable")
    return {"shard": shard, "doc_keys": keys, "n_words": n.tobytes(), "terms": h[by_hash].tobytes(),
            "counts": np.bincount(code, minlength=len(h)).astype(np.uint32).tobytes(), "positions": pos[order].tobytes()}


def build_index(docs: DataFrame, tables: Tables, id_col: str = "doc_id", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index table of ``docs``: rows as in ``INDEX_SCHEMA``. Documents are
    indexed whole; a shard takes documents until it has ``shard_bytes`` of text.
    Null texts have no words but keep their row."""

    def build(batches):
        part, made = TaskContext.get().partitionId(), 0
        keys, texts, size = [], [], 0
        for pdf in batches:
            for key, text in zip(pdf["k"], pdf["t"]):
                keys.append(key)
                texts.append(text)
                size += len(text or "")
                if size >= shard_bytes:
                    yield pd.DataFrame([_shard(f"{part}-{made}", keys, texts)])
                    keys, texts, size, made = [], [], 0, made + 1
        if keys:
            yield pd.DataFrame([_shard(f"{part}-{made}", keys, texts)])

    rows = docs.select(F.col(id_col).cast("string").alias("k"), F.col(text_col).alias("t"))
    return tables.save(rows.mapInPandas(build, INDEX_SCHEMA), "index")


def phrases(texts, window: int = WINDOW) -> dict[tuple, set]:
    """Distinct windows (tuples of words) of the item texts, each with the
    numbers of the items that hold it. An item of fewer words, but not none, is
    one window."""
    out: dict[tuple, set] = {}
    for i, t in enumerate(texts):
        w = words_of(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            out.setdefault(tuple(w[k:k + window]), set()).add(i)
    return out


class Shard:
    """Posting lists of one index row."""

    def __init__(self, row):
        self.n = np.frombuffer(row.n_words, np.int64)
        self.base = np.cumsum(self.n + 1) - (self.n + 1)
        self.terms = np.frombuffer(row.terms, np.uint64)
        self.end = np.cumsum(np.frombuffer(row.counts, np.uint32), dtype=np.int64)
        self.positions = np.frombuffer(row.positions, np.uint32)

    def lists(self, wanted: np.ndarray) -> dict[int, np.ndarray]:
        """Position list of each wanted term that the shard holds."""
        if not len(self.terms):
            return {}
        at = np.minimum(np.searchsorted(self.terms, wanted), len(self.terms) - 1)
        out = {}
        for t, k in zip(wanted[self.terms[at] == wanted].tolist(), at[self.terms[at] == wanted].tolist()):
            out[t] = self.positions[self.end[k - 1] if k else 0:self.end[k]].astype(np.int64)
        return out

    def doc_of(self, positions) -> np.ndarray:
        return np.searchsorted(self.base, positions, side="right") - 1


def match(lists: dict, terms: list[int], order: list[int], slop: int, shard: Shard) -> np.ndarray:
    """Phrase starts of ``terms`` (by place) in one shard; ``order``: places,
    rarest term first."""
    first = order[0]
    if terms[first] not in lists or any(t not in lists for t in terms):
        return np.zeros(0, np.int64)
    start = lists[terms[first]] - first
    for place in order[1:]:
        own = lists[terms[place]]
        want = start + place
        at = np.minimum(np.searchsorted(own, want - slop), len(own) - 1)
        ok = np.abs(own[at] - want) <= slop
        if slop:
            ok &= shard.doc_of(own[at]) == shard.doc_of(start + first)
        start = start[ok]
        if not len(start):
            break
    return start


def search(index: DataFrame, item_texts: list, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Matches of one block of test items: rows ``(shard, doc, spans,
    items)`` for documents with any. ``doc``: place in the shard; ``spans``: flat
    array of begin and end word numbers, disjoint and in order; ``items``:
    numbers of the items with an occurring window."""
    found = phrases(item_texts, window)
    vocabulary = sorted({w for p in found for w in p})
    ids = dict(zip(vocabulary, hashed(vocabulary).tolist()))
    wanted = np.array(sorted(set(ids.values())), np.uint64)

    def count(batches):
        for pdf in batches:
            for terms, counts in zip(pdf["terms"], pdf["counts"]):
                t, c = np.frombuffer(terms, np.uint64), np.frombuffer(counts, np.uint32)
                hit = np.isin(t, wanted, assume_unique=True)
                yield pd.DataFrame({"t": t[hit].view(np.int64), "n": c[hit].astype(np.int64)})

    total = index.select("terms", "counts").mapInPandas(count, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))
    freq = {t % (1 << 64): n for t, n in total.collect()}
    plans = []
    for words, items in found.items():
        terms = [ids[w] for w in words]
        if all(t in freq for t in terms):
            plans.append((terms, sorted(range(len(terms)), key=lambda i: (freq[terms[i]], i)), sorted(items)))

    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                shard, out = Shard(row), {}
                lists = shard.lists(wanted)
                for terms, order, items in plans:
                    start = match(lists, terms, order, slop, shard)
                    if len(start):
                        doc = shard.doc_of(start + order[0])
                        for d, s in zip(doc.tolist(), (start - shard.base[doc]).tolist()):
                            spans, hit = out.setdefault(d, ([], set()))
                            spans.append((max(0, s - slop), min(int(shard.n[d]), s + len(terms) + slop)))
                            hit.update(items)
                if out:
                    yield pd.DataFrame({"shard": row.shard, "doc": list(out), "spans": [merged(s) for s, _ in out.values()],
                                        "items": [sorted(i) for _, i in out.values()]})

    return index.drop("doc_keys").mapInPandas(run, "shard string, doc int, spans array<int>, items array<int>")


def merged(spans) -> list[int]:
    """Flat, disjoint, ordered form of ``(begin, end)`` pairs."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The test items in blocks of bounded text size, read one block at a time
    (``toLocalIterator`` holds one partition of the item table)."""
    cur, size = [], 0
    for key, text in items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_col).toLocalIterator():
        cur.append((key, text))
        size += len(text or "")
        if size >= block_bytes:
            yield pd.DataFrame(cur, columns=["k", "t"])
            cur, size = [], 0
    if cur:
        yield pd.DataFrame(cur, columns=["k", "t"])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, slop: int = 0,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row of ``docs``: its id, ``n_words``, ``n_hit`` (words
    inside an occurring window), ``n_items`` and ``items`` (sorted ids of items
    with occurring windows), ``contaminated`` (hit, and at least one word in
    twenty).

    Null and empty texts have no words; items without words match nothing; a
    null item id counts as the empty text; items of one id count once; repeated
    documents are judged each. Empty tables are allowed on both sides.
    """
    spark: SparkSession = docs.sparkSession
    tables = Tables(spark, "decontaminate")
    index = build_index(docs, tables, id_col, text_col)

    @F.pandas_udf("array<int>")
    def lengths(col: pd.Series) -> pd.Series:
        return col.map(lambda b: np.frombuffer(b, np.int64).tolist())

    hits = None
    for block in item_blocks(items, item_id_col, item_text_col, block_bytes):
        keys = F.array(*[F.lit(k) for k in block["k"]]) if len(block) <= 64 else F.from_json(
            F.lit(pd.Series(block["k"]).to_json(orient="values")), "array<string>")
        got = search(index, list(block["t"]), window, slop)
        got = tables.save(got.select("shard", "doc", "spans", F.transform("items", lambda i: F.get(keys, i)).alias("items")), "block")
        hits = got if hits is None else hits.unionByName(got)
    rows = index.select("shard", F.posexplode(F.arrays_zip("doc_keys", lengths("n_words").alias("n"))).alias("doc", "d")).select(
        "shard", "doc", F.col("d.doc_keys").cast(docs.schema[id_col].dataType).alias(id_col), F.col("d.n").cast("long").alias("n_words"))
    if hits is None:
        hits = spark.createDataFrame([], "shard string, doc int, spans array<int>, items array<string>")

    @F.pandas_udf("long")
    def covered(spans: pd.Series) -> pd.Series:
        def size(flat):
            m = merged(zip(flat[0::2].tolist(), flat[1::2].tolist()))
            return sum(m[1::2]) - sum(m[0::2])
        return spans.map(lambda s: size(np.asarray(s)))

    per_doc = hits.groupBy("shard", "doc").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    per_doc = tables.save(per_doc.select("shard", "doc", covered("spans").alias("n_hit"), "items"), "hits")
    out = rows.join(per_doc, ["shard", "doc"], "left").select(
        id_col, "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.select(id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                      ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **params) -> DataFrame:
    """The rows of ``docs`` (all their columns) whose text is not contaminated.
    Rows of one id are judged each by their own text: an id with clean and
    contaminated rows is judged again by row."""
    judged = contamination(docs, items, id_col, **params)
    bad = judged.groupBy(id_col).agg(F.max("contaminated").alias("bad"), F.min("contaminated").alias("all")).where("bad")
    tables = Tables(docs.sparkSession, "decontaminate-drop")
    bad = tables.save(bad, "bad")
    key = free_name(docs, "bad_id")
    ids = lambda part: bad.where(part).select(F.col(id_col).alias(key))
    same = F.col(id_col).eqNullSafe(F.col(key))
    clean = docs.join(ids("bad"), same, "left_anti")
    if bad.where("NOT all").isEmpty():
        return clean
    mixed = docs.join(ids("NOT all"), same, "left_semi")
    row = free_name(docs, "row")
    numbered = tables.save(mixed.withColumn(row, F.monotonically_increasing_id()), "mixed")
    ok = contamination(numbered, items, row, **params).where("NOT contaminated").select(F.col(row).alias(key))
    return clean.unionByName(numbered.join(ok, F.col(row) == F.col(key), "left_semi").select(*docs.columns))
