"""Packing documents into fixed-length token sequences by sums of squares.

Documents become token ids and an end id. Longer ones are cut into pieces of
``capacity`` tokens, of which the first may be shorter. A full piece is a
sequence of its own. The others are dealt at random (a hash of their row) to
groups of about ``GROUP_PIECES``; each group is packed on its own, longest piece
first: among the open sequences whose residual gap holds the piece, it goes
where the sum over all gaps of the squared number of open sequences with that
gap becomes smallest; a new sequence is opened only when no gap holds it (pieces
in falling order make that better than the rule's own choice to open one).
A group loses at most the unfilled rest of its last few sequences, whatever the
size of the input, and groups are packed in parallel.
"""

from __future__ import annotations

import base64
import binascii

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from firmlink.llm.common import Tables

CAPACITY = 1024
GROUP_PIECES = 50_000
END_ID = 2


class Encoder:
    """Ids of a byte-level BPE vocabulary as ``tokenizers`` gives them with
    ``add_special_tokens=False``. ``ranks`` names the same vocabulary as ranks:
    tiktoken gives equal ids several times faster, and is used for all texts
    that hold no string of a special token."""

    def __init__(self, model: str = "byte_bpe_50k.json", ranks: str | None = "byte_bpe_50k.tiktoken"):
        self.model = Tokenizer.from_file(public_tokenizers.path(model))
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            with open(public_tokenizers.path(ranks), "rb") as fh:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, fh)}
            self.fast = tiktoken.Encoding(model, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.special):
            return self.model.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` >= 1 ids."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


PIECE_SCHEMA = "doc string, piece int, start long, length long, ids_crc32 long, part int, row long"


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, with_ids: bool = False, model: str = "byte_bpe_50k.json",
           ranks: str | None = "byte_bpe_50k.tiktoken") -> DataFrame:
    """One row for each piece of each row of ``docs`` (null text: empty, one
    piece of the end id alone). ``part, row`` number the pieces; ``ids_crc32`` is
    the checksum of the little-endian 32-bit ids; ``with_ids`` adds ``ids``."""

    def run(batches):
        encode, part, row = Encoder(model, ranks), TaskContext.get().partitionId(), 0
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc"], pdf["text"]):
                ids = np.array([*encode(text or ""), end_id], dtype="<u4")
                for k, (start, n) in enumerate(cut(len(ids), capacity)):
                    own = ids[start:start + n]
                    rec = (doc, k, start, n, binascii.crc32(own.tobytes()), part, row)
                    out.append((*rec, own.astype(np.int64).tolist()) if with_ids else rec)
                    row += 1
            names = ["doc", "piece", "start", "length", "ids_crc32", "part", "row"] + ["ids"] * with_ids
            yield pd.DataFrame(out, columns=names)

    src = docs.select(F.col(id_col).cast("string").alias("doc"), F.col(text_col).alias("text"))
    return src.mapInPandas(run, PIECE_SCHEMA + (", ids array<long>" if with_ids else ""))


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece of a group (0 < length <=
    capacity), by the rule above. Ties go to the smallest gap and, within a gap,
    to the sequence that got it last."""
    order = np.argsort(-lengths, kind="stable")
    seq, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    n_open = np.zeros(capacity + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i in order.tolist():
        s = int(lengths[i])
        gaps = np.flatnonzero(n_open[s:]) + s
        if len(gaps):
            cost = np.where(gaps > s, 2 * n_open[gaps - s] + 1, 0) - 2 * n_open[gaps]
            g = int(gaps[np.argmin(cost)])
            k = open_at[g].pop()
            n_open[g] -= 1
        else:
            k, g, made = made, capacity, made + 1
        seq[i], offset[i] = k, capacity - g
        if g > s:
            open_at[g - s].append(k)
            n_open[g - s] += 1
    return seq, offset


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         group_pieces: int = GROUP_PIECES, **encoding) -> DataFrame:
    """The pieces of ``docs`` with ``sequence_id`` (unique over groups) and
    ``offset``; see ``pieces``. Repeated rows are packed each; an empty table
    gives no rows. The texts are encoded once and the piece table is written;
    packing shuffles three numbers of each short piece."""
    tables = Tables(docs.sparkSession, "packing")
    all_pieces = tables.save(pieces(docs, id_col, text_col, capacity, **encoding), "pieces")
    short = all_pieces.where(F.col("length") < capacity).select("part", "row", "length")
    groups = max(1, round(short.count() / group_pieces))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["part", "row"], ignore_index=True)
        seq, offset = place(pdf["length"].to_numpy(), capacity)
        return pd.DataFrame({"part": pdf["part"], "row": pdf["row"], "sequence_id": (pdf["g"].iloc[0] << 32) + seq, "offset": offset})

    g = F.pmod(F.xxhash64("part", "row"), F.lit(groups)).alias("g")
    placed = short.select("*", g).groupBy("g").applyInPandas(run, "part int, row long, sequence_id long, offset long")
    placed = tables.save(placed, "placed")
    out = all_pieces.join(placed, ["part", "row"], "left")
    own = -1 - (F.shiftleft(F.col("part").cast("long"), 38) + F.col("row"))
    return out.select(F.col("doc").cast(docs.schema[id_col].dataType).alias(id_col),
                      *[c for c in all_pieces.columns if c not in ("doc", "part", "row")],
                      F.coalesce("sequence_id", own).alias("sequence_id"), F.coalesce("offset", F.lit(0)).alias("offset"))
