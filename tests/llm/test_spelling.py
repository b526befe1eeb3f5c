"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from firmlink.llm import spelling
from firmlink.llm.queries import op13_spelling
from tests.conftest import SF001
from tests.llm.brute import ascii_lower

SCHEMA = "doc_id long, text string, word string, n string, id string, run string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(docs):
    count = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = ascii_lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            count[w[:h % len(w)] + w[h % len(w) + 1:] if h % 31 == 0 else w] += 1
    n = {w: k for w, k in count.items() if len(w) >= 7 and k >= 2}
    # Words that are near agree in their first or in their second half, but for a shift of one.
    halves = {}
    for w in n:
        for key in {w[:len(w) // 2], w[:(len(w) - 1) // 2], "-" + w[-(len(w) // 2):], "-" + w[-((len(w) - 1) // 2):]}:
            halves.setdefault(key, []).append(w)
    friends = {w: set() for w in n}
    for group in halves.values():
        for a in group:
            friends[a] |= {b for b in group if near(a, b)}
    form = {}
    for w in n:
        best = min(friends[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(friends[w]), n[form[w]] if form[w] else None))
    return out


def found(df):
    got = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got))
    return set(got)


def rows_of(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aé") for _ in range(rng.randint(6, 8))) for _ in range(60)]
    text = lambda: " ".join(rng.choice(words) for _ in range(40))
    rows = [(k, text()) for k in range(60)]
    chain = "beginning " * 2000 + "beginnin " * 150 + "beginnix " * 12 + "beginxix " * 2
    return rows + [(90, chain), (91, None), (92, ""), (93, "1 2 3"), (None, "Straße STRASSEN strassen ÀÉÎÕÜß×÷ÿ ÀÉÎÕÜß×÷ÿ Straßen"),
                   (94, "y" * 3000 + " " + "y" * 3000 + " " + "y" * 2999 + "ÿ " + "y" * 2999 + "ÿ " + ("y" * 2999 + " ") * 2),
                   (95, "repeated rows"), (95, "repeated rows"), (96, "z" * 70 + " " + "z" * 70 + " " + "z" * 71 + " " + "z" * 71),
                   (97, "tiesaaa " * 20 + "tiesaab " * 20 + "tiesaac tiesaac")]


@pytest.mark.parametrize("shard_words,round_bytes", [(spelling.SHARD_WORDS, spelling.ROUND_BYTES), (20, 200)])
def test_against_a_plain_version(spark, shard_words, round_bytes):
    rows = rows_of(4)
    want = plain(rows)
    assert any(r[1] != r[2] and r[1] for r in want) and any(r[4] > 3 for r in want)
    assert found(spelling.variants(docs_of(spark, rows), shard_words=shard_words, round_bytes=round_bytes)) == want


def test_edits_are_all_edits_and_their_hashes():
    words = ["banana", "ÿz", "aab"]
    alphabet = [chr(c) for c in [*range(0x61, 0x7B), *range(0xC0, 0x100)]]
    got = {}
    for length, h, wanted, name in spelling.edits(words, np.array([ord(c) for c in alphabet], np.uint64)):
        k = np.flatnonzero(wanted)
        for x, w, p, c in zip(h[k], *name(k)):
            made = words[w][:p] + (chr(c) if c else "") + words[w][p + 1:]
            assert spelling.length_class(len(made)) == length
            assert made not in got.setdefault(words[w], {})
            got[words[w]][made] = x
    for w in words:
        want = {w[:i] + w[i + 1:] for i in range(len(w))}
        want |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in alphabet if c > w[i]}
        assert set(got[w]) == want
        made = list(want)
        assert np.array_equal(spelling.hashes(made), np.array([got[w][x] for x in made], np.uint64))


def test_rounds_hold_every_shard_once_and_stay_small():
    shards = spelling.Shards({7: 1_000, 8: 10, 9: 0, 64: 333}, 100)
    rounds = shards.rounds(1000)
    assert sorted(x for r in rounds for x in r) == [(c, s) for c in sorted(shards.n) for s in range(shards.n[c])]
    assert all(sum(shards.blocks[c] * 64 for c, _ in r) <= 1000 for r in rounds) and 9 not in shards.n


def test_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, "short words")]):
        out = spelling.variants(docs_of(spark, rows))
        assert out.count() == 0 and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    assert found(op13_spelling(spark, SF001)) == plain(rows)
