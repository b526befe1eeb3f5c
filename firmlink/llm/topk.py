"""Exact top-k search by columnar branch and bound.

Vectors are turned into integers ``floor(scale * x)`` and kept in vertical
layout: one block of rows holds its values dimension by dimension. A task takes
blocks of rows against a block of queries. It adds up inner products one block
of dimensions after another; after each, a candidate's remaining mass (the
norm of its values in the dimensions still to come) times the query's own
bounds what it can still gain, and candidates whose bound is below the k-th
best score found so far, for every query of the tile, are compacted away. Only
survivors are summed to the end, so the result is exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmlink.llm.common import Tables

SCALE = 1024
DIM_BLOCK = 8
ROWS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 1024
TILE = 64
#: Query blocks are broadcast in passes of up to so many bytes.
BROADCAST_BYTES = 64 << 20

BLOCK_SCHEMA = "dim int, n int, ids binary, cells binary"


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``(id, dim, v)`` with integer components, without vectors that are null
    or hold null or non-finite components, and without null ids."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.where(F.col(id_col).isNotNull() & v.isNotNull()).where(fine)
            .select(F.col(id_col).cast("long").alias("id"), F.size(v).alias("dim"),
                    F.transform(v, lambda x: F.floor(x * F.lit(scale))).alias("v")))


def packed_block(dim: int, own: list) -> pd.DataFrame:
    """One block row: ids, and the values dimension by dimension."""
    m = np.array([np.asarray(v, np.int64) for _, v in own], np.int64).reshape(len(own), dim)
    ids = np.array([i for i, _ in own], np.int64)
    return pd.DataFrame([(dim, len(own), ids.tobytes(), np.ascontiguousarray(m.T).tobytes())],
                        columns=["dim", "n", "ids", "cells"])


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Rows of one dimension packed into blocks in vertical layout."""

    def run(batches):
        held: dict[int, list] = {}
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                own = held.setdefault(int(dim), [])
                own.extend(zip(part["id"], part["v"]))
                while len(own) >= rows:
                    yield packed_block(int(dim), own[:rows])
                    del own[:rows]
        for dim, own in held.items():
            if own:
                yield packed_block(dim, own)

    return vectors.mapInPandas(run, BLOCK_SCHEMA)


def unpacked(ids: bytes, cells: bytes, dim: int):
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(cells, np.int64).reshape(dim, len(i))


class Best:
    """The k best ``(score, id)`` of each query of a block so far: higher score
    first, then smaller id. Empty places hold the lowest score."""

    LOW = np.iinfo(np.int64).min + 1

    def __init__(self, ids, cells, k):
        self.ids, self.cells, self.k = ids, cells, k
        self.score = np.full((len(ids), k), self.LOW)
        self.id = np.zeros((len(ids), k), np.int64)

    def offer(self, tile: slice, ids, cells, dim_block: int) -> int:
        """Search the rows ``ids``, ``cells`` for the queries of ``tile``;
        returns the number of candidates summed to the end."""
        q = self.cells[:, tile].astype(np.float64)
        dim = len(q)
        exact = dim * np.abs(q).max(initial=0) * np.abs(cells).max(initial=0) < 1 << 53
        x = cells.astype(np.float64)
        edges = list(range(0, dim, dim_block)) + [dim]
        mass = lambda m: np.sqrt(np.cumsum((m * m)[::-1], 0)[::-1])  # noqa: E731  from each dimension on
        q_mass, x_mass = mass(q), mass(x)
        if not dim:
            q_mass, x_mass = np.zeros((1, q.shape[1])), np.zeros((1, len(ids)))
        slack = 1e-9 * q_mass[0][:, None] * x_mass[0].max(initial=0) + 1e-6  # rounding of the sums so far
        at = np.arange(len(ids))
        part = np.zeros((q.shape[1], len(ids)))
        kth = self.score[tile, -1].astype(np.float64)
        for a, b in zip(edges, edges[1:]):
            part += q[a:b].T @ x[a:b][:, at]
            if b < dim:
                gain = np.outer(q_mass[b], x_mass[b][at])
                live = (part + gain + slack >= kth[:, None]).any(0)
                if live.mean() < 0.9:
                    at, part = at[live], part[:, live]
            if not len(at):
                return 0
        if exact:
            total = part.astype(np.int64)
        else:
            total = self.cells[:, tile].T.astype(object) @ cells[:, at].astype(object)
            total = np.clip(total, self.LOW + 1, -self.LOW).astype(np.int64)
        qi = self.ids[tile]
        total[qi[:, None] == ids[at][None, :]] = self.LOW
        ones = np.broadcast_to(ids[at], total.shape)
        if total.shape[1] > 4 * self.k:
            kk = total.shape[1] - self.k
            cut = np.partition(total, kk, axis=1)[:, kk]
            keep = (total >= cut[:, None]).any(0)
            total, ones = total[:, keep], ones[:, keep]
        score = np.concatenate([self.score[tile], total], axis=1)
        who = np.concatenate([self.id[tile], ones], axis=1)
        order = np.lexsort((who, -score), axis=1)[:, :self.k]
        self.score[tile] = np.take_along_axis(score, order, 1)
        self.id[tile] = np.take_along_axis(who, order, 1)
        return len(at)

    def frame(self) -> pd.DataFrame:
        full = self.score > self.LOW
        return pd.DataFrame({"query_id": np.broadcast_to(self.ids[:, None], full.shape)[full],
                             "id": self.id[full], "score": self.score[full]})


def top_k(rows: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE, dim_block: int = DIM_BLOCK, rows_per_block: int = ROWS_PER_BLOCK,
          queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """``(query_id, rank, id_col, score)``: the ``k`` rows with the highest
    integer inner product for each query, without rows of the query's own id;
    ties go to the smaller id; all rows where there are fewer.

    Vectors that are null, or hold null or non-finite components, and rows
    without an id take no part; a query meets rows of its own number of
    dimensions. Rows of one id are separate candidates; a repeated query row is
    answered once. Sums beyond 2**53 are computed with unbounded integers and
    clipped to the range of a long; components are clipped to it by ``floor``.

    The query set is cut into blocks; each row block meets each query block of
    its dimension once. Query blocks are broadcast in passes of at most
    ``BROADCAST_BYTES``, so a larger query set takes more passes over the stored
    row blocks, not more memory. A task carries its k best of a query from block
    to block; what it hands on is k rows for each query, not its candidates.
    """
    tables = Tables(rows.sparkSession, "topk")
    wanted = integer_vectors(queries, id_col, vec_col, scale).groupBy("dim", "id").agg(F.min("v").alias("v"))
    wanted = tables.save(wanted, "queries")
    n, dims = wanted.agg(F.count("*"), F.max("dim")).first()
    n_blocks = max(1, -(-n // queries_per_block))
    packed = tables.save(
        wanted.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(n_blocks))).groupBy("dim", "qb")
        .applyInPandas(lambda key, pdf: packed_block(int(key[0]), list(zip(pdf["id"], pdf["v"]))).assign(qb=int(key[1])),
                       BLOCK_SCHEMA + ", qb long"), "query-blocks")
    stored = tables.save(blocks(integer_vectors(rows, id_col, vec_col, scale), rows_per_block), "row-blocks")
    per_pass = max(1, BROADCAST_BYTES // (8 * queries_per_block * (2 + (dims or 1))))

    def run(batches):
        best: dict[tuple, Best] = {}
        for pdf in batches:
            for r in pdf.itertuples():
                key = (r.dim, r.qb)
                if key not in best:
                    best[key] = Best(*unpacked(r.q_ids, r.q_cells, r.dim), k)
                ids, cells = unpacked(r.ids, r.cells, r.dim)
                for t in range(0, len(best[key].ids), TILE):
                    best[key].offer(slice(t, t + TILE), ids, cells, dim_block)
        for b in best.values():
            yield b.frame()

    found = None
    for first in range(0, n_blocks, per_pass):
        part = packed.where((F.col("qb") >= first) & (F.col("qb") < first + per_pass)).select(
            "dim", "qb", F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"))
        one = tables.save(stored.join(F.broadcast(part), "dim").mapInPandas(run, "query_id long, id long, score long"), "found")
        found = one if found is None else found.unionByName(one)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score")
