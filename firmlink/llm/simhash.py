"""SimHash near-duplicates with pigeonring filtering.

Fingerprint: texts are lower-cased (A-Z only) and split into words at ASCII
white space; every shingle of ``shingle`` words (repeats included; a shorter
text is one shingle of all its words) is hashed with XXH64, seed 42; a bit of
the 64-bit fingerprint is 1 if it is set in over half the hashes. No words:
fingerprint zero, linked like any other.

Linking: two fingerprints link at ``max_bits`` or fewer differing bits. The 64
bits are cut into ``m = 2 * max_bits + 1`` segments on a ring. By the pigeonring
principle a linked pair has a start segment from which every chain of l
consecutive segments differs in at most ``floor(l * max_bits / m)`` bits: none
in the first two, one at most over the first four. So such a pair agrees on
segments ``(i, i+1, i+2)`` or ``(i, i+1, i+3)`` for some i: these are the join
keys. Candidates whose chains exceed their budgets are dropped before the full
Hamming check. No linked pair is lost, for any input.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlink.llm.common import BROADCAST_IDS, Tables, free_name, link_buckets

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a text; 0 for a null text or no words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    end = np.cumsum([len(w) + 1 for w in words])
    begin = np.append(0, end[:-1])
    last = np.minimum(np.arange(n) + shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    total, step = np.zeros(64, np.int64), 1 << 16
    for k in range(0, n, step):
        spans = zip(begin[k:min(n, k + step)].tolist(), (end[last[k:k + step]] - 1).tolist())
        h = np.fromiter((digest(joined[i:j], SEED) for i, j in spans), np.uint64, min(n, k + step) - k)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "simhash", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit long added (a column of
    that name is replaced). A map over rows; only the text enters Python."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    tmp = free_name(docs, "fp")
    scored = docs.withColumn(tmp, simhash(F.col(text_col)))
    return scored.select(*[c for c in docs.columns if c.lower() != out.lower()], F.col(tmp).alias(out))


def segments(max_bits: int) -> list[tuple[int, int]]:
    """``(shift, width)`` of the ring's segments, low bits first."""
    m = 2 * max_bits + 1
    edges = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segment(x, seg):
    return x if seg[1] == 64 else F.shiftrightunsigned(x, seg[0]).bitwiseAND(F.lit((1 << seg[1]) - 1))


def chain_keys(fp, max_bits: int = MAX_BITS):
    """Array of the join keys of a fingerprint: agreeing segment sets, numbered
    and hashed into one long."""
    segs = segments(max_bits)
    m = len(segs)
    if m == 1:
        return F.array(fp)
    sets = [(i, (i + 1) % m) for i in range(m)] if m == 3 else [
        (i, (i + 1) % m, (i + j) % m) for i in range(m) for j in (2, 3)]
    return F.array(*[F.xxhash64(F.lit(n), *[_segment(fp, segs[s]) for s in ss]) for n, ss in enumerate(sets)])


def prefix_viable(diff, max_bits: int = MAX_BITS):
    """True where some start segment has all its chains within budget."""
    segs = segments(max_bits)
    m = len(segs)
    ones = [F.bit_count(_segment(diff, s)) for s in segs]
    out = F.lit(False)
    for i in range(m):
        total, ok = F.lit(0), F.lit(True)
        for length in range(1, m + 1):
            total = total + ones[(i + length - 1) % m]
            ok = ok & (total <= length * max_bits // m)
        out = out | ok
    return out


def link(prints: DataFrame, max_bits: int = MAX_BITS, tables: Tables | None = None) -> DataFrame:
    """``(id, component)`` for distinct fingerprints (column ``id``) that link
    with another one; ``component`` is the smallest of its class."""
    tables = tables or Tables(prints.sparkSession, "simhash")
    members = prints.select(F.explode(F.array_distinct(chain_keys(F.col("id"), max_bits))).alias("key"), "id")
    diff = F.col("a").bitwiseXOR(F.col("b"))
    return link_buckets(
        members, lambda p: p.where(prefix_viable(diff, max_bits)).where(F.bit_count(diff) <= max_bits), tables)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row ``(id_col, fingerprint, component_id)`` for each row of ``docs``:
    the fingerprint as 16 hex digits, and the smallest id reachable over links,
    its own included.

    Null text: no words. Rows of one id are judged each by their own text. A
    null id is ignored as a component's smallest id (null only when no row of
    the class has one). An empty table gives no rows.

    Equal fingerprints are one node: copies, however many, cost one row of the
    link graph. The texts are read once; everything later moves longs.
    """
    return _classes(docs, id_col, text_col, shingle, max_bits).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _classes(docs, id_col, text_col, shingle, max_bits) -> DataFrame:
    """``(id, fp, component_id, c)`` for each row; c is the class's smallest
    fingerprint."""
    tables = Tables(docs.sparkSession, "simhash")
    fp = tables.save(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", "fp", shingle)
                     .select("id", "fp"), "fingerprints")
    nodes = tables.save(fp.groupBy("fp").agg(F.min("id").alias("low")), "nodes")
    comp = link(nodes.select(F.col("fp").alias("id")), max_bits, tables)
    labelled = nodes.join(comp.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("c"))
    lows = labelled.groupBy("c").agg(F.min("low").alias("component_id"))
    return fp.join(labelled.join(lows, "c").select("fp", "component_id", "c"), "fp")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` (all its columns) for each class: one with the
    class's smallest id. Where an id occurs in several rows, they are told
    apart by their fingerprints. A class without any id keeps one row too.

    Ids whose rows do not all stay are sent to the texts (up to ``BROADCAST_IDS``;
    more are joined by a shuffle), so that the texts need not move."""
    tables = Tables(docs.sparkSession, "simhash-drop")
    rows = tables.save(_classes(docs, id_col, text_col, shingle, max_bits), "classes")
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    ids = rows.groupBy("id").agg(F.count("*").alias("n"), F.max(kept).alias("k"))
    ids = tables.save(ids.where("NOT k OR n > 1 OR id IS NULL"), "ids")
    other_id = free_name(docs, "other_id")
    others = ids.where("id IS NOT NULL").select(F.col("id").alias(other_id))
    others = F.broadcast(others) if others.count() <= BROADCAST_IDS else others
    out = docs.where(F.col(id_col).isNotNull()).join(others, F.col(id_col) == F.col(other_id), "left_anti")
    ids = ids.where("k")
    if ids.isEmpty():
        return out
    fp, c, other, other_fp, other_text = (free_name(docs, x) for x in ("fp", "c", "other", "other_fp", "other_text"))
    many = rows.where(kept).join(ids.select(F.col("id").alias("i")), F.col("id").eqNullSafe(F.col("i")))
    many = many.select(F.col("id").alias(other), F.col("fp").alias(other_fp), F.col("c").alias(c)).distinct()
    again = fingerprints(docs.withColumn(other_text, F.col(text_col)), other_text, fp, shingle)
    again = again.join(many, F.col(id_col).eqNullSafe(F.col(other)) & (F.col(fp) == F.col(other_fp)))
    return out.unionByName(again.dropDuplicates([id_col, c]).select(*docs.columns))
