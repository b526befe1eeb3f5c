"""The prefix trie of conversations against a plain version."""

import hashlib
import random
import zlib

import pytest

from firmlink.llm import prefix_trie
from firmlink.llm.queries import op12_prefix_trie
from tests.conftest import SF001

SCHEMA = "conv_id long, turn long, role string, text string, path string, digest string, key string, n_convs string"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    return out


def nodes(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out, sums = set(), {}
    for p in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids.get(p, [])]
        leaves = sum(x[0] for x in below) or 1
        saved = sum(x[1] for x in below) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        sums[p] = leaves, saved
        ends = ",".join(str(c) for c in sorted(c for c in members[p] if len(convs[c]) == len(p)))
        out.add((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below), leaves, saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = [tuple(r) for r in df.select(cols).collect()]
    assert len(got) == len(set(got))
    return set(got)


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 130), 205, 207, 399, 1000]:
        for k in range(rng.randint(1, 6)):
            rows.append((c, k, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é\U0001F600", "", None])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_version(spark, seed):
    rows = random_rows(seed)
    assert found(prefix_trie.conversation_trie(rows_of(spark, rows))) == nodes(rebuilt(rows))


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [(0, None, "user", "first"), (0, 1, "user", "b"), (0, 1, "user", "a"), (0, 1, "assistant", "z"), (0, 2, None, None),
            (0, 2, None, None), (None, 0, "user", "nobody"), (301, 0, "user", "lost"), (4, 0, "user", "only"), (100, 0, "", "a"),
            (101, 0, None, "a"), (102, 0, "a", ""), (7, 3, "user", "x" * 100_000)]
    want = rebuilt(rows)
    assert [] in want.values()
    assert found(prefix_trie.conversation_trie(rows_of(spark, rows))) == nodes(want)


@pytest.mark.parametrize("long", [1, 3, 16])
def test_long_conversations_and_unshared_tails(spark, long):
    rng = random.Random(5)
    common = [rng.choice("abc") for _ in range(9)]
    rows = []
    for c in range(300, 330):
        own = common[:rng.randint(1, 9)] + [rng.choice("ab") * rng.randint(1, 3) for _ in range(rng.randint(0, 14))]
        rows += [(c, k, "user", t) for k, t in enumerate(own)]
    for c in (340, 341, 342):
        rows += [(c, k, "user", f"turn {k}") for k in range(25 + 5 * (c == 342))]
    paths = prefix_trie.share_heads(prefix_trie.turn_paths(rows_of(spark, rows), prefix_trie.Tables(spark, "test")))
    assert found(prefix_trie.trie(paths, long=long)) == nodes(rebuilt(rows))


def test_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(c, k, "user", "same") for c in range(0, 400) for k in range(3)]
    assert found(prefix_trie.conversation_trie(rows_of(spark, rows))) == nodes(rebuilt(rows))


def test_empty_table(spark):
    out = prefix_trie.conversation_trie(rows_of(spark, []))
    assert out.count() == 0 and "ends_sha256" in out.columns


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op12_prefix_trie(spark, SF001)) == nodes(rebuilt(rows))
