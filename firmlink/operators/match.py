"""Exact and blocked fuzzy matching of registry names against crawl names.

Everything is done on *distinct names*, not rows: the score of a row pair
depends only on the two normalised names, so each name pair is scored once and
joined back to rows at the end.

Candidate generation (pairs that share the block key and may reach ``lo``) is
exact:

1. the names of a block and a length class (lengths of equally many bits) are
   dealt by hash into chunks of about ``CHUNK_NAMES``, on both sides, so that no
   block, however hot, meets in one task;
2. each pair of chunks of a block whose lengths allow it (a tile) is one row, and
   the tiles are spread over the tasks. A tile's length and multiset bounds are found by whole arrays,
   at some nanoseconds a pair; pairs below them are never rows. Each pair of
   names lies in one tile, so there is nothing to de-duplicate;
3. for scoring, the tile also drops the pairs whose longest common subsequence
   keeps them below ``lo`` (bit operations on arrays);
4. the Arrow UDF scores only what is left.

All pairs of a block are bounded, so the work of a hot block grows with the
product of its two sides, but its rows, shuffles and disk do not.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmlink.config import MatchConfig
from firmlink.functions.similarity import (
    NameTile,
    char_tokens,
    length_bound,
    min_overlap,
    ratio_from_udf,
)
from firmlink.functions.text import MATCH_EXACT, block_key, norm_name
from firmlink.operators.project import project_once

#: Names of one side of a tile (a tile holds about the square of it in pairs), and
#: the characters they may have together, which lessens the number of long ones.
CHUNK_NAMES, CHUNK_CHARS = 1024, 1 << 18
PAIR_COLUMNS = "r_norm string, c_norm string, bk string, r_len int, c_len int, overlap int"
REGISTRY_ATTRS = ["entity_name", "entity_type", "address", "postcode", "state"]


def prepare_registry(registry: DataFrame) -> DataFrame:
    """Registry rows with their normalised name (NULL names never match)."""
    cols = ["abn", *REGISTRY_ATTRS]
    return project_once(registry, cols, {"norm": norm_name("entity_name")}).filter(
        F.col("norm").isNotNull()
    )


def prepare_crawl(crawl: DataFrame) -> DataFrame:
    return project_once(
        crawl, ["domain", "extracted_industry"], {"norm": norm_name("extracted_name")}
    ).filter(F.col("norm").isNotNull())


def registry_by_name(reg: DataFrame) -> DataFrame:
    """One registry row per ``(norm, abn)``: the first by the attribute
    tie-break of the final pick (pre-aggregation; NULL ``abn`` rows of one
    name collapse here exactly as they would in the final pick), with the
    number of source rows it stands for."""
    best = F.min(F.struct(*REGISTRY_ATTRS)).alias("_r")
    rows = F.count(F.lit(1)).alias("n_rows")
    return reg.groupBy("norm", "abn").agg(best, rows).select("norm", "abn", "_r.*", "n_rows")


def crawl_by_name(crawl: DataFrame) -> DataFrame:
    """One crawl row per ``(norm, domain)``; the industry is the first in the
    final tie-break order (NULLs first), so this pre-aggregation cannot change
    the final pick."""
    ind = F.col("extracted_industry")
    first_ind = F.when(F.count(F.lit(1)) > F.count(ind), F.lit(None)).otherwise(F.min(ind))
    return crawl.groupBy("norm", "domain").agg(
        first_ind.alias("extracted_industry"), F.count(F.lit(1)).alias("n_rows")
    )


def name_table(names: DataFrame, cfg: MatchConfig, prefix: str) -> DataFrame:
    """Distinct names with block key, length, occurrence tokens and the
    tokens outside the block key. Names shorter than the block key only
    equal themselves (the exact path), so they are left out.

    This and :func:`_token_pairs` are an index of single names by their rare
    characters; :func:`candidate_pairs` bounds whole tiles instead."""
    n = F.col("norm")
    bk = block_key(n, cfg.block_chars)
    toks = char_tokens(n)
    return names.filter(F.length(n) >= cfg.block_chars).select(
        n.alias(f"{prefix}_norm"),
        bk.alias("bk"),
        F.length(n).alias(f"{prefix}_len"),
        toks.alias(f"{prefix}_toks"),
        F.array_except(toks, char_tokens(bk)).alias(f"{prefix}_rest"),
    )


def exact_name_pairs(reg_names: DataFrame, cc_names: DataFrame) -> DataFrame:
    """Equal normalised names: score 1.0, type EXACT."""
    return reg_names.join(cc_names, "norm", "inner").select(
        F.col("norm").alias("r_norm"),
        F.col("norm").alias("c_norm"),
        F.lit(1.0).alias("fuzzy_score"),
        F.lit(MATCH_EXACT).alias("match_type"),
    )


def _prefix_tokens(names: DataFrame, side: str, rank: DataFrame, cfg: MatchConfig) -> DataFrame:
    """First tokens outside the block key, rarest first.

    Two names of one block share its ``block_chars`` key tokens, so a pair
    needs ``t - block_chars`` more common tokens, where ``t`` is the overlap
    the bound requires. The prefix holds ``len - block_chars - max(t -
    block_chars, 1) + 1`` tokens; pairs whose bound is met by the key alone
    need not share one.
    """
    norm, length, rest = f"{side}_norm", f"{side}_len", f"{side}_rest"
    exploded = names.select(
        norm, "bk", length, f"{side}_toks", F.size(rest).alias(f"{side}_nrest"), F.explode(rest).alias("tok")
    )
    w = Window.partitionBy(norm).orderBy("df", "tok")
    bc = F.lit(cfg.block_chars)
    keep = F.col(length) - bc - F.greatest(min_overlap(F.col(length), cfg.lo) - bc, F.lit(1)) + 1
    return (
        exploded.join(rank, "tok", "inner")
        .withColumn(f"{side}_pos", F.row_number().over(w))
        .filter(F.col(f"{side}_pos") <= keep)
        .drop("df")
    )


def _token_pairs(r: DataFrame, c: DataFrame, cfg: MatchConfig) -> DataFrame:
    """One row per shared prefix token of two names that passes the positional
    and length filters."""
    # Document frequency of each token over both name sets; a few thousand
    # rows at most (alphabet x longest name), so AQE broadcasts it at runtime.
    rank = (
        r.select(F.explode("r_rest").alias("tok"))
        .unionByName(c.select(F.explode("c_rest").alias("tok")))
        .groupBy("tok")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    rp = _prefix_tokens(r, "r", rank, cfg)
    cp = _prefix_tokens(c, "c", rank, cfg)
    # Positional filter: at a shared token at prefix positions (i, j), the
    # rest overlap is at most 1 + min(rest_r - i, rest_c - j); it must reach
    # what the pair itself needs beyond the key. Each valid pair keeps at
    # least the row of its first shared token, so the filter is exact.
    need = F.ceil(F.lit(cfg.lo / 2.0) * (F.col("r_len") + F.col("c_len")) - F.lit(1e-9)) - F.lit(cfg.block_chars)
    reach = F.lit(1) + F.least(F.col("r_nrest") - F.col("r_pos"), F.col("c_nrest") - F.col("c_pos"))
    return (
        rp.join(cp, ["bk", "tok"], "inner")
        .filter((reach >= need) & (length_bound(F.col("r_len"), F.col("c_len")) >= F.lit(cfg.lo)))
        .select("r_norm", "c_norm", "bk", "r_len", "c_len", "r_toks", "c_toks")
    )


def _chunks(names: DataFrame, side: str, cfg: MatchConfig, hold: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """``(bk, bits, chunk, names)``: the names of each block and length class in
    chunks. Names shorter than the block key only equal themselves (the exact path)."""
    keyed = names.where(F.length("norm") >= cfg.block_chars).select(
        "norm", block_key("norm", cfg.block_chars).alias("bk"), F.length(F.bin(F.length("norm"))).alias("bits"))
    keyed = hold(keyed) if hold is not None else keyed
    room = F.greatest(F.lit(1), F.least(F.lit(CHUNK_NAMES), F.floor(F.lit(CHUNK_CHARS) / F.pow(F.lit(2.0), "bits"))))
    sizes = keyed.groupBy("bk", "bits").agg(F.ceil(F.count(F.lit(1)) / room).alias("n"))
    chunk = F.pmod(F.xxhash64("norm"), F.col("n")).alias(f"{side}_chunk")
    return keyed.join(sizes, ["bk", "bits"]).groupBy("bk", F.col("bits").alias(f"{side}_bits"), chunk).agg(
        F.collect_list("norm").alias(f"{side}_names"))


def tile_pairs(lo: float, subsequence: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: tiles ``(bk, r_names, c_names)`` to their unequal pairs
    that reach the bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bk, r, c in zip(batch.column("bk"), batch.column("r_names"), batch.column("c_names")):
                r_names, c_names = r.as_py(), c.as_py()
                c_place = {n: j for j, n in enumerate(c_names)}
                same = np.array([c_place.get(n, -1) for n in r_names])
                tile = NameTile(r_names, c_names)
                for i, j, overlap in tile.overlapping(lo):
                    keep = same[i] != j
                    if subsequence:
                        keep &= 2.0 * tile.subsequences(i, j) / (tile.la[i] + tile.lb[j]) >= lo - 1e-9
                    i, j, overlap = i[keep], j[keep], overlap[keep]
                    if len(i):
                        yield pa.RecordBatch.from_arrays(
                            [r.values.take(pa.array(i)), c.values.take(pa.array(j)), pa.repeat(bk, len(i)),
                             *[pa.array(x, pa.int32()) for x in (tile.la[i], tile.lb[j], overlap)]],
                            names=["r_norm", "c_norm", "bk", "r_len", "c_len", "overlap"])

    return run


def candidate_pairs(reg_names: DataFrame, cc_names: DataFrame, cfg: MatchConfig,
                    hold: Callable[[DataFrame], DataFrame] | None = None, subsequence: bool = False) -> DataFrame:
    """Distinct unequal name pairs in one block that pass the length and
    multiset bounds: ``(r_norm, c_norm, bk, r_len, c_len, overlap)``; with
    ``subsequence`` only those that pass the subsequence bound too.

    ``reg_names``/``cc_names`` hold one column ``norm`` of distinct non-NULL
    names. ``hold`` (e.g. :func:`materialize`) is applied to the two tables of
    names with their keys, which the block sizes and the chunks both read.
    """
    # by the length bound the longer name has at most (2 - lo) / lo times the length
    # of the shorter, so the bits of their lengths differ by its logarithm at most
    apart = math.ceil(math.log2((2.0 - cfg.lo) / cfg.lo) + 1e-9)
    tiles = _chunks(reg_names, "r", cfg, hold).join(_chunks(cc_names, "c", cfg, hold), "bk")
    tiles = tiles.where(F.abs(F.col("r_bits") - F.col("c_bits")) <= apart)
    # an explicit partition count: adaptive coalescing goes by bytes and would
    # put tiles of few bytes, however many pairs they hold, into one task
    parts = int(reg_names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = tiles.repartition(parts, "bk", "r_bits", "c_bits", "r_chunk", "c_chunk").select("bk", "r_names", "c_names")
    return tiles.mapInArrow(tile_pairs(cfg.lo, subsequence), PAIR_COLUMNS)


def score_pairs(cands: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Similarity of each candidate pair, kept when ``>= lo``. The edit bound
    is checked before the UDF, the subsequence bound in it."""
    room = F.lit(1.0 - cfg.lo) * (F.length("r_norm") + F.length("c_norm")) + F.lit(1e-6)
    near = cands.where(F.levenshtein("r_norm", "c_norm") <= room)
    return (
        near.select("r_norm", "c_norm", ratio_from_udf(cfg.lo)("r_norm", "c_norm").alias("fuzzy_score"))
        .filter(F.col("fuzzy_score") >= F.lit(cfg.lo))
    )


def band(score_col, cfg: MatchConfig):
    s = F.col(score_col) if isinstance(score_col, str) else score_col
    return F.when(s >= F.lit(cfg.hi), F.lit("HIGH")).when(s >= F.lit(cfg.lo), F.lit("BORDERLINE"))
