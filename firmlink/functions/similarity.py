"""Ratcliff/Obershelp similarity and the native bounds that prune pairs
before it is computed.

``ratio(a, b) = 2*M / (len(a) + len(b))`` where ``M`` is the number of
characters in the matching blocks found by :class:`difflib.SequenceMatcher`
(registry name first; the measure is not symmetric). These bounds hold for every
pair; the first three cost no Python:

* length bound: ``2*min(la, lb) / (la + lb) >= ratio``;
* multiset bound: ``2*overlap / (la + lb) >= ratio``, where ``overlap`` is the
  size of the multiset intersection of the two character bags;
* edit bound: replacing what lies between the matching blocks turns one text
  into the other, so ``levenshtein(a, b) <= (1 - ratio) * (la + lb)``;
* subsequence bound: the matching blocks are one common subsequence, so ``M`` is
  at most the length of the longest one (found with bit operations in the batch,
  before the matcher runs).

The bounds of all pairs of two name lists are found by whole arrays (``NameTile``).
As columns, characters are encoded as tokens ``"<char>#<k>"`` (k-th occurrence), so the
multiset intersection is a plain ``array_intersect`` of token arrays.
"""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmlink.functions.text import _c


def char_places(text: str) -> dict[str, int]:
    """Bit ``i`` of a character's number is set where ``text[i]`` is it."""
    places: dict[str, int] = {}
    for i, ch in enumerate(text):
        places[ch] = places.get(ch, 0) | 1 << i
    return places


def common_subsequence(a: str, places: dict[str, int], n: int) -> int:
    """Length of the longest common subsequence of ``a`` and a text of ``n``
    characters with these places: one row of the table for each character of
    ``a``, held as the bits of one number (zero where the row grows)."""
    full = (1 << n) - 1
    row = full
    for ch in a:
        hit = row & places.get(ch, 0)
        row = (row + hit | row - hit) & full
    return n - row.bit_count()


def name_codes(names: list[str], alphabet: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of some names end to end, as ``(name, place, code)``; characters
    are numbered in ``alphabet``, which grows."""
    lengths = np.array([len(n) for n in names], dtype=np.int64)
    codes = np.array([alphabet.setdefault(ch, len(alphabet)) for n in names for ch in n], dtype=np.int64)
    name = np.repeat(np.arange(len(names)), lengths)
    return name, np.arange(len(codes)) - (np.cumsum(lengths) - lengths)[name], codes


class NameTile:
    """The bounds of all pairs of two name lists, by whole arrays."""

    PAIRS = 1 << 18      # pairs bounded at once
    SUBSEQUENCES = 1 << 15

    def __init__(self, a: list[str], b: list[str]):
        alphabet: dict[str, int] = {}
        self.a, self.b = name_codes(a, alphabet), name_codes(b, alphabet)
        self.chars = len(alphabet)
        self.la, self.lb = (np.array([len(n) for n in names], dtype=np.int64) for names in (a, b))
        self._indexed = None

    def _counts(self, side, n: int, kind) -> np.ndarray:
        name, _, code = side
        return np.bincount(code * n + name, minlength=self.chars * n).reshape(self.chars, n).astype(kind)

    def overlapping(self, lo: float):
        """``(i, j, overlap)`` of the pairs whose length and multiset bounds reach
        ``lo``, in slabs; ``overlap`` is the size of the multiset intersection."""
        na, nb = len(self.la), len(self.lb)
        if not na or not nb:
            return
        # an overlap is at most the shorter length
        kind = np.min_scalar_type(int(max(self.la.max(), self.lb.max())))
        ca, cb = self._counts(self.a, na, kind), self._counts(self.b, nb, kind)
        both = np.flatnonzero(ca.any(axis=1) & cb.any(axis=1))
        step = max(1, self.PAIRS // nb)
        for s in range(0, na, step):
            la = self.la[s:s + step, None]
            overlap = np.zeros((len(la), nb), dtype=kind)
            least = np.empty_like(overlap)
            for ch in both:
                overlap += np.minimum(ca[ch, s:s + step, None], cb[ch][None, :], out=least)
            total = (la + self.lb).astype(np.float64)
            reach = 2.0 * np.minimum(la, self.lb) / total >= lo
            reach &= 2.0 * overlap.astype(np.float64) / total >= lo
            i, j = np.nonzero(reach)
            yield i + s, j, overlap[i, j].astype(np.int64)

    def _index(self):
        """Codes of the first names by place (a code without places behind their
        ends), and the places of each code in the second names as bits of words."""
        name, place, code = self.a
        text = np.full((int(self.la.max()), len(self.la)), self.chars, dtype=np.int64)
        text[place, name] = code
        name, place, code = self.b
        words = []
        for w in range(int(self.lb.max()) + 63 >> 6):
            here = place >> 6 == w
            at = np.zeros((self.chars + 1, len(self.lb)), dtype=np.uint64)
            np.bitwise_or.at(at, (code[here], name[here]), np.uint64(1) << (place[here] & 63).astype(np.uint64))
            words.append(at.ravel())
        return text, words

    def subsequences(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of each pair: the rows of
        :func:`common_subsequence`, held in words of 64 bits, for many pairs."""
        out = np.zeros(len(i), dtype=np.int64)
        if not len(i):
            return out
        if self._indexed is None:
            self._indexed = self._index()
        text, words = self._indexed
        order = np.argsort(self.la[i] + self.lb[j], kind="stable")
        for s in range(0, len(order), self.SUBSEQUENCES):
            part = order[s:s + self.SUBSEQUENCES]
            a, b = i[part], j[part]
            used = words[:int(self.lb[b].max()) + 63 >> 6]
            rows = [np.full(len(part), ~np.uint64(0)) for _ in used]
            for k in range(int(self.la[a].max())):
                at = text[k].take(a) * len(self.lb) + b
                carry = None
                for w, places in enumerate(used):
                    row = rows[w]
                    hit = row & places.take(at)
                    grown = row + hit
                    if len(used) > 1:
                        over = grown < row
                        if carry is not None:
                            grown += carry
                            over |= grown < carry
                        carry = over.astype(np.uint64)
                    rows[w] = grown | (row ^ hit)
            for w, row in enumerate(rows):
                # zero bits are steps of the row; bits behind the text's end do not count
                left = np.clip(self.lb[b] - 64 * w, 0, 64)
                mask = np.where(left == 64, ~np.uint64(0), (np.uint64(1) << (left & 63).astype(np.uint64)) - np.uint64(1))
                out[part] += np.bitwise_count(~row & mask).astype(np.int64)
        return out


def ratios(a: pd.Series, b: pd.Series, lo: float = 0.0, score=SequenceMatcher.ratio) -> pd.Series:
    """Ratios of a batch. The matcher indexes its second text, so the pairs are
    taken in the order of those and each is indexed once. Pairs whose longest
    common subsequence keeps them below ``lo`` get 0.0 without the matcher."""
    out = np.zeros(len(a))
    matcher, indexed = SequenceMatcher(None), None
    places, fed = {}, None
    first, second = a.to_numpy(dtype=object), b.to_numpy(dtype=object)
    for i in sorted(range(len(second)), key=lambda k: second[k] or ""):
        if not first[i] or not second[i]:
            continue
        if second[i] != indexed:
            indexed = second[i]
            places = char_places(indexed) if lo > 0 else {}
        if lo > 0:
            total = len(first[i]) + len(indexed)
            if 2.0 * common_subsequence(first[i], places, len(indexed)) / total < lo - 1e-9:
                continue
        if fed != indexed:
            fed = indexed
            matcher.set_seq2(fed)
        matcher.set_seq1(first[i])
        out[i] = score(matcher)
    return pd.Series(out)


def _ratio_batch(a: pd.Series, b: pd.Series) -> pd.Series:
    return ratios(a, b)


# Arrow-batched similarity; the only Python in the matching path. It is
# deterministic, but flagged otherwise so that Catalyst keeps it where it is
# written: a filter on its result would otherwise be pushed below the pair
# de-duplication and the bound filters, scoring every raw join row.
ratio_udf = F.pandas_udf(_ratio_batch, T.DoubleType()).asNondeterministic()


def ratio_from_udf(lo: float):
    """``ratio_udf`` for scores of ``lo`` and more; lower ones may come as 0.0."""

    def batch(a: pd.Series, b: pd.Series) -> pd.Series:
        return ratios(a, b, lo)

    return F.pandas_udf(batch, T.DoubleType()).asNondeterministic()


def char_tokens(name: Column | str) -> Column:
    """Array of distinct tokens ``char#k`` (k-th occurrence of ``char``).

    Per distinct character, its count comes from native string functions
    (``length - length(replace)``) and ``char#1..char#count`` are emitted:
    work proportional to length x distinct characters, no per-position
    sub-arrays. Token order is irrelevant to every consumer.
    """
    n = _c(name)
    distinct_chars = F.array_distinct(F.split(n, ""))
    return F.flatten(
        F.transform(
            distinct_chars,
            lambda c: F.transform(
                F.sequence(F.lit(1), F.length(n) - F.length(F.replace(n, c, F.lit("")))),
                lambda k: F.concat(c, F.lit("#"), k.cast("string")),
            ),
        )
    )


def length_bound(la: Column, lb: Column) -> Column:
    return 2.0 * F.least(la, lb) / (la + lb)


def multiset_bound(tokens_a: Column, tokens_b: Column, la: Column, lb: Column) -> Column:
    return 2.0 * F.size(F.array_intersect(tokens_a, tokens_b)) / (la + lb)


def min_overlap(length: Column, lo: float) -> Column:
    """Smallest multiset overlap any partner of a name of this length needs to
    reach ``lo``: ``ceil(lo * length / (2 - lo))`` (with a tolerance that only
    ever lowers it, so the filter stays exact)."""
    return F.ceil(length * F.lit(lo / (2.0 - lo)) - F.lit(1e-6)).cast("int")


def min_overlap_py(length: int, lo: float) -> int:
    return math.ceil(length * lo / (2.0 - lo) - 1e-6)
