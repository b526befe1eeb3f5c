"""Spelling variants of words, by Bloom-guided neighbourhoods.

The vocabulary is counted over all texts with map-side sums. Its words go into
blocked Bloom filters, sharded by word length and, beyond a fixed size, by hash.
Each word's edits (a code point replaced by a larger one that the vocabulary has,
a code point deleted; every near pair is such an edit from one of its ends) are made
as hashes only, by arithmetic on a polynomial hash, and probed against the filters.
Only positive edits become strings and are joined with the vocabulary, which
removes the filters' false positives.

A filter shard holds at most about ``SHARD_WORDS`` words and one round broadcasts
at most ``ROUND_BYTES`` of shards; a larger vocabulary takes more rounds over the
same words, so the broadcast does not grow with the data. Filters have no false
negatives, so no near pair is lost.

A word's near words are at most a fixed multiple of its length, so no group grows
with its square. Forms are strictly more frequent (tenfold), so chains of forms are
shorter than 19 and five doublings of the pointers find every root.

Defined results: a null text has no words; a null id counts as the empty text;
repeated rows (equal ids and texts) count as documents of their own; ties between
near words go to the smallest in code-point order; an empty table, or one without
a word, gives no rows; other columns are not read. Runs of any length are words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlink.llm.common import Tables, id_text

#: The letters of words; lower-cased words consist of at most 90 code points.
LETTER = "[A-Za-zÀ-ÿ]"
#: Words of this length or more share the last length class.
LAST_LENGTH = 64
SHARD_WORDS = 500_000
BITS_PER_WORD = 16
ROUND_BYTES = 64 << 20
_PROBES = 7
#: Edits held at once by a task.
_EDITS = 1 << 18
#: Positive edits sent on at once.
_HITS = 100_000
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def runs(texts: DataFrame, id_col: str, text_col: str, misspell: int = 31, min_length: int = 1) -> DataFrame:
    """One row ``word`` for each run of ``min_length`` letters or more, A-Z in lower case. Where
    ``misspell`` divides the CRC-32 h of ``<id>:<run>``, the code point
    ``h % length`` is left out."""
    found = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTER}{{{min_length},}}"), F.lit(0)))
    low = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = texts.select(id_text(id_col).alias("id"), found.alias("run")).select("id", low.alias("run"))
    rows = rows.withColumn("h", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return rows.select(F.when(F.col("h") % misspell == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2) -> DataFrame:
    """``(word, n)`` for words of enough code points and occurrences."""
    return (runs(docs, id_col, text_col, min_length=min_length).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def _mix(h):
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _by_length(words: list[str], letters: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(places in words, code points)`` for the words of each length, the latter as a matrix."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        step = max(1, _EDITS // (int(size) * letters))
        for k in range(0, len(at), step):
            some = at[k:k + step]
            flat = np.frombuffer("".join(words[i] for i in some).encode("utf-32-le"), np.uint32)
            yield some, flat.reshape(len(some), size).astype(np.uint64)


def _powers(size: int) -> np.ndarray:
    """The hash's factors for the places of a word."""
    up = np.full(size, _BASE, np.uint64)
    up[0] = 1
    return np.multiply.accumulate(up)[::-1]


def length_class(size: int) -> int:
    return min(int(size), LAST_LENGTH)


def hashes(words: list[str]) -> np.ndarray:
    """The polynomial hash of each word, modulo 2**64."""
    out = np.zeros(len(words), np.uint64)
    for at, codes in _by_length(words):
        out[at] = (codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)
    return out


def edits(words: list[str], alphabet: np.ndarray) -> Iterator[tuple]:
    """Batches of all edits as ``(length class, hashes, wanted, name)``: of the
    hashes, those that ``wanted`` marks are edits, and ``name(k)`` gives the words
    (places in ``words``), the places in the word and the code points of edits
    ``k``. The code point replaces that at the place; 0 stands for a deletion. Of
    deletions with the same result only the first is made."""
    letters = len(alphabet)
    piece = max(1, _EDITS // letters)
    for at, codes in _by_length(words, letters):
        size = codes.shape[1]
        power = _powers(size)
        terms = codes * power
        whole = terms.sum(axis=1, dtype=np.uint64)
        sums = np.cumsum(terms, axis=1, dtype=np.uint64)
        gone = (sums - terms) * np.uint64(_BACK) + (whole[:, None] - sums)
        first = np.ones(codes.shape, bool)
        first[:, 1:] = codes[:, 1:] != codes[:, :-1]
        yield (length_class(size - 1), gone.ravel(), first.ravel(),
               lambda k, at=at, size=size: (at[k // size], k % size, np.zeros(len(k), np.uint64)))
        for j in range(0, size, piece):
            part = codes[:, j:j + piece, None]
            new = whole[:, None, None] + (alphabet - part) * power[j:j + piece, None]
            wide = part.shape[1]
            yield (length_class(size), new.ravel(), (alphabet > part).ravel(),
                   lambda k, at=at, wide=wide, j=j: (at[k // (wide * letters)], k // letters % wide + j, alphabet[k % letters]))


class Shards:
    """How the filters are split: for each length class the number of shards,
    each for the words of one range of hashes."""

    def __init__(self, counts: dict[int, int], shard_words: int = SHARD_WORDS):
        self.n = {c: -(-n // shard_words) for c, n in counts.items() if n}
        # Even shards with some room; a filter's error grows slowly beyond it.
        self.blocks = {c: max(1, -(-counts[c] * BITS_PER_WORD // (512 * n))) for c, n in self.n.items()}

    def of(self, length: int, mixed: np.ndarray) -> np.ndarray:
        return ((mixed >> np.uint64(32)) * np.uint64(self.n[length])) >> np.uint64(32)

    def rounds(self, most: int) -> list[set[tuple[int, int]]]:
        out, room = [], 0
        for c in sorted(self.n):
            for s in range(self.n[c]):
                need = self.blocks[c] * 64
                if not out or need > room:
                    out.append(set())
                    room = most
                out[-1].add((c, s))
                room -= need
        return out

    def places(self, length: int, mixed: np.ndarray, probe: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell and bit of one probe; all probes of a hash lie in one block of 512 bits."""
        block = ((mixed & np.uint64(0xFFFFFFFF)) * np.uint64(self.blocks[length])) >> np.uint64(32)
        field = ((mixed * np.uint64(_BASE)) >> np.uint64(55 - 9 * probe)) & np.uint64(511)
        return (block * np.uint64(8) + (field >> np.uint64(6))).astype(np.int64), np.uint64(1) << (field & np.uint64(63))


def filters(vocab: DataFrame, shards: Shards) -> DataFrame:
    """``(length, shard, bits)``, one blocked Bloom filter for each shard."""

    def hashed(batches):
        for b in batches:
            words = b["word"].tolist()
            h = _mix(hashes(words))
            length = np.fromiter((length_class(len(w)) for w in words), np.int64, len(words))
            shard = np.zeros(len(words), np.int64)
            for c in np.unique(length):
                shard[length == c] = shards.of(int(c), h[length == c])
            yield pd.DataFrame({"length": length, "shard": shard, "h": h.view(np.int64)})

    def build(key, rows):
        c, h = int(key[0]), rows["h"].to_numpy().view(np.uint64)
        bits = np.zeros(shards.blocks[c] * 8, np.uint64)
        for p in range(_PROBES):
            cell, bit = shards.places(c, h, p)
            np.bitwise_or.at(bits, cell, bit)
        return pd.DataFrame({"length": [c], "shard": [int(key[1])], "bits": [bits.tobytes()]})

    return (vocab.select("word").mapInPandas(hashed, "length long, shard long, h long")
            .groupBy("length", "shard").applyInPandas(build, "length long, shard long, bits binary"))


def positives(vocab: DataFrame, shards: Shards, letters: list[int], sent) -> DataFrame:
    """``(word, n, edit)`` for the edits that the filters of the broadcast ``sent`` hold."""
    columns = ["word", "n", "edit"]

    def probe(batches):
        cells, alphabet = {k: np.frombuffer(v, np.uint64) for k, v in sent.value.items()}, np.array(letters, np.uint64)
        by_length = {c: sorted(s for d, s in cells if d == c) for c, _ in cells}
        for b in batches:
            words, n, hits = b["word"].tolist(), b["n"].tolist(), []
            for length, h, wanted, name in edits(words, alphabet):
                mixed = _mix(h) if length in by_length else None
                for s in by_length.get(length, ()):
                    live = np.flatnonzero(wanted if shards.n[length] == 1 else wanted & (shards.of(length, mixed) == s))
                    for p in range(_PROBES):
                        cell, bit = shards.places(length, mixed[live], p)
                        live = live[(cells[length, s][cell] & bit) != 0]
                    for w, p, c in zip(*(x.tolist() for x in name(live))):
                        hits.append((words[w], n[w], words[w][:p] + (chr(c) if c else "") + words[w][p + 1:]))
                if len(hits) > _HITS:
                    yield pd.DataFrame(hits, columns=columns)
                    hits = []
            if hits:
                yield pd.DataFrame(hits, columns=columns)

    return vocab.select("word", "n").mapInPandas(probe, "word string, n long, edit string")


def near_pairs(vocab: DataFrame, tables: Tables, shard_words: int = SHARD_WORDS, round_bytes: int = ROUND_BYTES) -> DataFrame | None:
    """``(word, n, other, other_n)``, each pair of near words of the stored
    ``vocab`` once; None for an empty vocabulary."""
    spark = vocab.sparkSession
    size = F.least(F.length("word"), F.lit(LAST_LENGTH))
    shards = Shards({r["c"]: r["k"] for r in vocab.groupBy(size.alias("c")).agg(F.count("*").alias("k")).collect()}, shard_words)
    if not shards.n:
        return None
    built = tables.save(filters(vocab, shards), "filters")
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).where("letter != ''").distinct()
    letters = sorted(ord(r["letter"]) for r in letters.collect())
    spread = vocab.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    known = vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    found = []
    for now in shards.rounds(round_bytes):
        chosen = F.struct(F.col("length"), F.col("shard")).isin([F.struct(F.lit(c).cast("long"), F.lit(s).cast("long")) for c, s in sorted(now)])
        sent = spark.sparkContext.broadcast({(r["length"], r["shard"]): bytes(r["bits"]) for r in built.where(chosen).collect()})
        hits = positives(spread, shards, letters, sent)
        found.append(tables.save(hits.join(known, F.col("edit") == F.col("other")).drop("edit"), "pairs"))
        sent.destroy()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def roots(forms: DataFrame, tables: Tables) -> DataFrame:
    """``(word, root)`` for stored ``forms`` (word, form), all forms non-null: the last word of each chain."""
    cur, moved = forms.select("word", F.col("form").alias("root")), True
    while moved:
        step = cur.select(F.col("word").alias("at"), F.col("root").alias("on"))
        cur = tables.save(cur.join(step, F.col("root") == F.col("at"), "left")
                          .select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")), "roots")
        moved = not cur.where("moved").isEmpty()
        cur = cur.drop("moved")
    return cur


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", factor: int = 10,
             shard_words: int = SHARD_WORDS, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """One row for each word: ``word, form, root, n, n_near, form_n``. A word's
    form is its near word of largest n, if that is ``factor`` times its own."""
    spark = docs.sparkSession
    tables = Tables(spark, "spelling")
    vocab = tables.save(vocabulary(docs, id_col, text_col), "vocabulary")
    pairs = near_pairs(vocab, tables, shard_words, round_bytes)
    if pairs is None:
        return spark.createDataFrame([], "word string, form string, root string, n long, n_near long, form_n long")
    both = pairs.select(F.inline(F.array(
        F.struct(F.col("word").alias("of"), F.col("other").alias("near"), F.col("other_n").alias("near_n")),
        F.struct(F.col("other").alias("of"), F.col("word").alias("near"), F.col("n").alias("near_n")))))
    best = both.groupBy("of").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("down"), "near")).alias("best"))
    often = -F.col("best.down") >= F.col("n") * factor
    words = tables.save(vocab.join(best, F.col("word") == F.col("of"), "left").select(
        "word", F.when(often, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, -F.col("best.down")).alias("form_n")), "words")
    last = roots(words.where("form IS NOT NULL"), tables).select(F.col("word").alias("of"), F.col("root").alias("last"))
    return words.join(last, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")
