"""Stupid-backoff language-model scores (Brants et al. 2007) of all documents.

The score of a word after its context is the relative frequency of the longest
n-gram that ends there and occurs in the corpus, times ``ALPHA`` for each word
cut off the context. Counts come from all documents; with ``leave_out`` (the
default) a document's own occurrences are taken off before it is scored, as its
n-grams would all be known otherwise.

The relations, and how they meet:

* *n-grams* (chunk, n-gram, count): a chunk is some documents of one task, its
  n-grams of all orders are counted in the task and sent as one sorted block to
  each part of the hash space;
* *count table*, partitioned by hash: a part adds up the counts of its n-grams
  over all chunks. It is joined to the chunks' n-grams where it stands: the part
  answers each block with the corpus counts in the block's order;
* *documents*: a chunk's answers meet its words again (grouped by chunk), and
  the scores of its n-grams are summed for each document.

The blocks are by far the largest relation, so the hash space is asked in ``ROUNDS``
rounds: the answers of a round, much smaller, are saved before the next one, and
its blocks can go. All n-grams are asked, each in one round.

An n-gram is a 64-bit hash (``KEY_BITS``), equal for all tasks; sorted blocks are
sent as differences. Every part and chunk has a bounded size, and a frequent
n-gram is one number in each block, so there are no hot keys.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlink.llm.common import Tables
from firmlink.llm.substring import mix, planes, unplanes

ORDER = 3
ALPHA = 0.4
KEY_BITS = 64
CHUNK_WORDS, PART_BYTES = 800_000, 4 << 20
#: Rounds in which the parts of the hash space are asked, one after another.
ROUNDS = 4

U = np.uint64
CHUNK_SCHEMA = "chunk string, docs array<string>, n binary, vocabulary binary, codes binary"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: lower-cased (A-Z), split at ASCII white space."""
    return text.encode().lower().split() if text else []


def chunk_row(name: str, docs: list, texts: list) -> tuple:
    words = [words_of(t) for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    flat = np.empty(int(n.sum()), dtype=object)
    flat[:] = [w for ws in words for w in ws]
    codes, uniques = pd.factorize(flat) if len(flat) else (np.zeros(0, np.int64), np.zeros(0, object))
    names = pd.util.hash_array(uniques, categorize=False) if len(uniques) else np.zeros(0, np.uint64)
    by_name = np.argsort(names)  # sorted names are sent as their differences
    rank = np.empty(len(names), np.int64)
    rank[by_name] = np.arange(len(names))
    return name, docs, n.tobytes(), planes(np.diff(names[by_name], prepend=U(0)), 8), planes(rank[codes], 4)


def names_of(row) -> np.ndarray:
    """The word name of each word of a chunk."""
    return np.cumsum(unplanes(row.vocabulary, 8), dtype=np.uint64)[unplanes(row.codes, 4).astype(np.int64)]


def grams(names: np.ndarray, n: np.ndarray, order: int) -> list[np.ndarray]:
    """For each length 1..order the key of the n-gram that ends at each word;
    words with too few words before them in their text hold no key of that
    length (their entry is not to be used: see ``depth``)."""
    shift = U(64 - KEY_BITS)
    out, h = [], np.zeros(len(names), np.uint64)
    for k in range(1, order + 1):
        older = np.append(np.zeros(k - 1, np.uint64), names[:len(names) - k + 1])[:len(names)]
        h = mix(h * U(0x9E3779B97F4A7C15) + older + U(k))
        out.append(mix(h + U(k)) >> shift)
    return out


def depth(n: np.ndarray) -> np.ndarray:
    """Number of words of its text up to each word, itself included."""
    return np.arange(1, int(n.sum()) + 1) - np.repeat(np.cumsum(n) - n, n)


def counted(names, n, order):
    """Sorted distinct keys of all n-grams of a chunk; and for each length the
    place of each word's n-gram among them (-1: none)."""
    keys, deep = grams(names, n, order), depth(n)
    has = [deep >= k for k in range(1, order + 1)]
    distinct, inverse = np.unique(np.concatenate([k[h] for k, h in zip(keys, has)]) if len(names) else np.zeros(0, np.uint64),
                                  return_inverse=True)
    places, at = [], 0
    for h in has:
        place = np.full(len(names), -1, np.int64)
        place[h] = inverse[at:at + int(h.sum())]
        at += int(h.sum())
        places.append(place)
    return distinct, places


def edge(p: int, parts: int) -> int:
    """The least key of a part of the hash space."""
    return ((p << KEY_BITS) + parts - 1) // parts


def ask(row, order: int, parts: int, begin: int = 0, end: int | None = None):
    """Blocks ``(p, chunk, keys, counts)`` of one chunk for the parts from ``begin``
    up to ``end``."""
    end = parts if end is None else end
    n = np.frombuffer(row.n, np.int64)
    names = names_of(row)
    low, high, deep = U(edge(begin, parts)), U(edge(end, parts) - 1), depth(n)
    keys = [key[(deep >= k) & (key >= low) & (key <= high)] for k, key in enumerate(grams(names, n, order), 1)] if len(names) else []
    distinct, number = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_counts=True)
    inner = np.array([edge(p, parts) for p in range(begin + 1, end)], np.uint64)
    cut = np.concatenate([[0], np.searchsorted(distinct, inner), [len(distinct)]]).astype(np.int64)
    for p in np.flatnonzero(np.diff(cut)).tolist():
        own = distinct[cut[p]:cut[p + 1]]
        yield begin + p, row.chunk, planes(np.diff(own, prepend=U(0)), 8), planes(number[cut[p]:cut[p + 1]], 4)


def answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts for the blocks of one part."""
    keys = [np.cumsum(unplanes(b, 8), dtype=np.uint64) for b in pdf["keys"]]
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate([unplanes(b, 4) for b in pdf["counts"]]), minlength=len(distinct))
    total = total.astype(np.int64)[inverse]
    ends = np.cumsum([len(k) for k in keys])
    return pd.DataFrame({"chunk": pdf["chunk"], "p": pdf["p"],
                         "counts": [planes(t, 6) for t in np.split(total, ends[:-1])]})


def score_chunk(row, totals: np.ndarray, corpus_words: int, order: int, alpha: float, leave_out: bool):
    """``(number of words, sum of natural logarithms)`` of each text of a chunk;
    ``totals``: corpus counts of the chunk's sorted distinct keys."""
    n = np.frombuffer(row.n, np.int64)
    names = names_of(row)
    distinct, places = counted(names, n, order)
    doc = np.repeat(np.arange(len(n)), n)
    have = []
    for place in places:
        c, real = np.zeros(len(place), np.int64), np.flatnonzero(place >= 0)
        c[real] = totals[place[real]]
        if leave_out:
            _, inv, own = np.unique(doc[real] * len(distinct) + place[real], return_inverse=True, return_counts=True)
            c[real] -= own[inv]
        have.append(c)
    base = np.maximum(corpus_words - (n if leave_out else 0 * n), 1)[doc]
    value = np.log(np.maximum(have[0], 1) / base) + (order - 1) * np.log(alpha)
    done = np.zeros(len(doc), bool)
    for k in range(order - 1, 0, -1):
        context = np.append(0, have[k - 1][:-1])[:len(doc)]
        seen = ~done & (have[k] > 0)
        value[seen] = np.log(have[k][seen] / np.maximum(context[seen], 1)) + (order - 1 - k) * np.log(alpha)
        done |= seen
    return n, np.bincount(doc, weights=value, minlength=len(n))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                    alpha: float = ALPHA, leave_out: bool = True, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row ``(id_col, n_words, log_score, mean_log_score)`` for each row of
    ``docs``: the sum of the natural logarithms of its words' scores, and that by
    word.

    The first words of a text are scored with the context they have, which
    counts as cut off. A word that occurs nowhere (else) counts as one
    occurrence. With ``leave_out`` rows of one id are different documents, and
    repeated rows support each other. Null and empty texts have no words, sum 0
    and a null mean. An empty table gives no rows.
    """
    tables = Tables(docs.sparkSession, "lm")

    def read(batches):
        part, made, names, texts, size = TaskContext.get().partitionId(), 0, [], [], 0
        cols = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")]
        for pdf in batches:
            for d, t in zip(pdf["d"], pdf["t"]):
                names.append(d)
                texts.append(t)
                size += len(t or "") // 6 + 1
                if size >= CHUNK_WORDS:
                    yield pd.DataFrame([chunk_row(f"{part}-{made}", names, texts)], columns=cols)
                    names, texts, size, made = [], [], 0, made + 1
        if names:
            yield pd.DataFrame([chunk_row(f"{part}-{made}", names, texts)], columns=cols)

    src = docs.select(F.col(id_col).cast("string").alias("d"), F.col(text_col).alias("t"))
    chunks = tables.save(src.mapInPandas(read, CHUNK_SCHEMA), "chunks")
    corpus_words = chunks.agg(F.sum(F.octet_length("codes")).alias("b")).first()["b"] or 0
    corpus_words //= 4
    parts = max(1, -(-corpus_words * 6 // part_bytes))

    def blocks(begin: int, end: int):
        def run(batches):
            for pdf in batches:
                for row in pdf.itertuples():
                    got = list(ask(row, order, parts, begin, end))
                    if got:
                        yield pd.DataFrame(got, columns=["p", "chunk", "keys", "counts"])

        return run

    rounds = min(ROUNDS, parts)
    answers = []
    for r in range(rounds):
        asked = chunks.drop("docs").mapInPandas(
            blocks(r * parts // rounds, (r + 1) * parts // rounds), "p int, chunk string, keys binary, counts binary")
        answers.append(tables.save(asked.groupBy("p").applyInPandas(answer, "chunk string, p int, counts binary"), "answers"))
    answers = reduce(DataFrame.unionByName, answers)

    def total(words: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        replies = replies.sort_values("p")
        totals = np.concatenate([np.zeros(0, np.int64), *[unplanes(b, 6).astype(np.int64) for b in replies["counts"]]])
        for row in words.itertuples():
            n, value = score_chunk(row, totals, corpus_words, order, alpha, leave_out)
            out.append(pd.DataFrame({"d": list(row.docs), "n_words": n, "log_score": value}))
        return pd.concat(out) if out else pd.DataFrame({"d": [], "n_words": [], "log_score": []})

    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(total, "d string, n_words long, log_score double")
    return scored.select(F.col("d").cast(docs.schema[id_col].dataType).alias(id_col), "n_words", "log_score",
                         F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_log_score"))
