"""Passages, decontamination, packing, language-model scores."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from firmlink.llm import decontaminate, lm_score, packing, substring
from firmlink.llm.queries import QUERIES
from tests.conftest import SF001
from tests.llm import brute
from tests.llm.test_near_duplicates import docs_of


def repetitive_rows(seed=1):
    """Small vocabulary, runs, copies and shared passages."""
    rng = random.Random(seed)
    words = ["a", "b", "c", "dd", "e'e", "F"]
    shared = [" ".join(rng.choice(words) for _ in range(n)) for n in (19, 20, 21, 45)]
    rows = []
    for d in range(60):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            parts.append(rng.choice(shared + ["a " * rng.randint(1, 50), "a b " * rng.randint(1, 25)]))
            parts.append(" ".join(rng.choice(words) for _ in range(rng.randint(0, 8))))
        rows.append((d * 3, rng.choice([" ", "\t", "\n"]).join(parts)))
    return rows + [(1, None), (4, ""), (7, rows[5][1]), (10, "no\u00a0break space " * 30)]


def test_passages_against_brute_force(spark):
    rows = repetitive_rows()
    for window, rounds, part in ((20, 4, 1 << 24), (20, 4, 500), (5, 2, 300), (20, 7, 1000)):
        got = substring.remove_repeats(docs_of(spark, rows), window=window, rounds=rounds, part_bytes=part).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got} == \
            brute.passages(rows, window)


def test_passages_in_small_chunks(spark, monkeypatch):
    rows = repetitive_rows(2)
    monkeypatch.setattr(substring, "CHUNK_WORDS", 200)
    got = substring.remove_repeats(docs_of(spark, rows).repartition(3), part_bytes=2000).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got} == brute.passages(rows)


def test_passages_on_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = brute.passages([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = QUERIES["op3_substring"](spark, SF001).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


def test_passages_with_a_phrase_in_a_third_of_the_texts(spark):
    rng = random.Random(8)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    short, long = text(12), text(23)
    rows = [(d, " ".join([text(rng.randint(15, 30)), *[short, long][:d % 3 == 0 or 2 * (d % 30 == 1)], text(rng.randint(15, 30))]))
            for d in range(900)]
    got = substring.remove_repeats(docs_of(spark, rows), part_bytes=8000).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got} == brute.passages(rows)

    def windows(bound):
        src = docs_of(spark, rows, "o long, t string")
        sent = substring.sent_blocks(src, 40, 20, substring.ROUNDS, bound).select("p", (F.length("sums") / substring.SUM_BYTES).alias("n"))
        return [r.n for r in sent.groupBy("p").agg(F.sum("n").alias("n")).collect()]

    even, all_equal_keys_meet = windows(400), windows(10**9)
    assert max(all_equal_keys_meet) > 3 * sum(even) / 40
    assert max(even) < 2 * sum(even) / 40


def test_texts_meet_their_ranges_by_one_plan_at_every_size(spark):
    plan = substring.remove_repeats(docs_of(spark, [(1, "a b c d"), (2, "a b c d")]), window=3)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_passages_repeated_ids_and_columns(spark):
    t = " ".join(str(i) for i in range(25))
    rows = [(1, t, 9), (1, t, 9), (None, t, 9)]
    got = substring.remove_repeats(docs_of(spark, rows, "doc_id long, text string, n_words int"))
    assert got.columns == ["doc_id", "text", "n_words", "n_removed", "kept_text"]
    assert sorted(r.n_removed for r in got.collect()) == [0, 25, 25]
    assert substring.remove_repeats(docs_of(spark, [])).count() == 0


def test_decontamination_against_brute_force(spark):
    rng = random.Random(4)
    vocab = ["alpha", "Beta", "gamma9", "é", "x", "the", "of"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 5, 13, 14, 30]))) for i in range(12)] + [(3, text(20)), (50, None), (None, text(14))]
    docs = [(d, " ".join([text(rng.randint(0, 40)), rng.choice(items)[1] or "", text(rng.randint(0, 200))])) for d in range(40)]
    docs += [(100, None), (101, ""), (102, "...")]
    want = brute.contaminated(docs, [("" if i is None else i, t) for i, t in items])
    for kw in ({}, {"block_bytes": 40}):
        got = decontaminate.contamination(docs_of(spark, docs), docs_of(spark, items, "item_id long, text string"), **kw).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got} == want


def test_decontamination_of_the_smallest_table(spark):
    read = lambda n, *c: [tuple(r) for r in spark.read.parquet(f"{SF001}/{n}.parquet").select(*c).collect()]
    want = brute.contaminated(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    got = QUERIES["op9_decontamination"](spark, SF001).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == {
        d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), c) for d, (n, h, i, c) in want.items()}


def test_proximity_matches(spark):
    docs = docs_of(spark, [(1, "one two extra three"), (2, "three two one"), (3, "one x x x two three")])
    items = docs_of(spark, [(7, "one two three")], "item_id long, text string")
    near = {r.doc_id: r.n_items for r in decontaminate.contamination(docs, items, slop=1).collect()}
    exact = {r.doc_id: r.n_items for r in decontaminate.contamination(docs, items).collect()}
    assert near == {1: 1, 2: 0, 3: 0} and exact == {1: 0, 2: 0, 3: 0}


def test_drop_contaminated(spark):
    bad = "this passage is in the benchmark"
    rows = [(1, bad, "a"), (1, "clean text", "b"), (2, bad, "c"), (3, None, "d"), (None, bad, "e"), (4, "clean", "f")]
    docs = docs_of(spark, rows, "doc_id long, text string, bad_id string")
    items = docs_of(spark, [(1, bad)], "item_id long, text string")
    got = decontaminate.drop_contaminated(docs, items)
    assert got.columns == docs.columns and sorted(r.bad_id for r in got.collect()) == ["b", "d", "f"]
    assert decontaminate.drop_contaminated(docs, docs_of(spark, [], "item_id long, text string")).count() == 6
    assert decontaminate.drop_contaminated(docs_of(spark, []), items).count() == 0


def check_packing(rows, got, capacity):
    """Pieces are exact, sequences gapless and few."""
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    for d, t in rows:
        ids, at = np.array([*model.encode(t or "", add_special_tokens=False).ids, 2], "<u4"), 0
        for k, r in enumerate(sorted(by_doc[d], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and zlib.crc32(ids[at:at + r.length].tobytes()) == r.ids_crc32
            assert r.length == capacity or (k == 0 and 0 < r.length < capacity)
            at += r.length
        assert at == len(ids)
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by_seq), -(-sum(r.length for r in got) // capacity)


def test_packing_of_the_smallest_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    used, least = check_packing(rows, QUERIES["op2_packing"](spark, SF001).collect(), 1024)
    assert used <= least + 3


def test_packing_edges(spark):
    rows = [(1, None), (2, ""), (3, "a" * 9000), (4, "x <|endoftext|> y"), (5, "word " * 1023), (6, "word " * 1024), (7, "ü\u0000\n")]
    got = packing.pack(docs_of(spark, rows)).collect()
    check_packing(rows, got, 1024)
    assert packing.pack(docs_of(spark, [])).count() == 0
    assert packing.pack(docs_of(spark, [(None, "a"), (None, "a"), (1, "a"), (1, "a")])).count() == 4
    ids = packing.pack(docs_of(spark, [(1, "some text")]), with_ids=True).first()["ids"]
    assert ids[-1] == 2 and len(ids) == 3


def test_place_is_sum_of_squares():
    lengths = np.array([700, 700, 324, 324, 324, 200, 124, 1])
    seq, offset = packing.place(lengths, 1024)
    assert seq[2] == seq[0] or seq[2] == seq[1]
    assert offset[2] == 700 and len(set(seq)) == 3


def lm_brute(rows, order, alpha, leave_out):
    words = [brute.SPACE_WORD.findall(brute.ascii_lower(t or "")) for _, t in rows]
    grams = lambda w: collections.Counter(tuple(w[i:i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1))
    corpus, out = sum((grams(w) for w in words), collections.Counter()), {}
    total = sum(map(len, words))
    for (d, _), w in zip(rows, words):
        own, value = grams(w) if leave_out else collections.Counter(), 0.0
        c = lambda g: corpus[g] - own[g]  # noqa: E731, B023
        base = max(total - (len(w) if leave_out else 0), 1)
        for i in range(len(w)):
            for k in range(min(order, i + 1), 0, -1):
                g = tuple(w[i + 1 - k:i + 1])
                if k == 1 or c(g) > 0:
                    p = max(c(g), 1) / base if k == 1 else c(g) / max(c(g[:-1]), 1)
                    value += math.log(p) + (order - k) * math.log(alpha)
                    break
        out[d] = (len(w), value)
    return out


def test_lm_scores_against_brute_force(spark, monkeypatch):
    rows = [(d, t) for d, t in repetitive_rows(9)]
    for order, leave_out in ((3, True), (2, False), (1, True)):
        got = lm_score.score_documents(docs_of(spark, rows), order=order, leave_out=leave_out, part_bytes=3000).collect()
        want = lm_brute(rows, order, 0.4, leave_out)
        assert {r.doc_id: r.n_words for r in got} == {d: n for d, (n, _) in want.items()}
        assert all(math.isclose(r.log_score, want[r.doc_id][1], rel_tol=1e-9, abs_tol=1e-9) for r in got)
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in got)
    monkeypatch.setattr(lm_score, "CHUNK_WORDS", 150)
    again = lm_score.score_documents(docs_of(spark, rows).repartition(2), order=3, part_bytes=3000).collect()
    want = lm_brute(rows, 3, 0.4, True)
    assert all(math.isclose(r.log_score, want[r.doc_id][1], rel_tol=1e-9, abs_tol=1e-9) for r in again)
    assert lm_score.score_documents(docs_of(spark, [])).count() == 0
    assert lm_score.score_documents(docs_of(spark, [(None, None), (None, "a b"), (None, "a b")])).count() == 3


def test_lm_blocks_are_asked_in_rounds(spark):
    rows = [(d, t) for d, t in repetitive_rows(9)]
    names, texts = zip(*rows)
    row = pd.DataFrame([lm_score.chunk_row("0-0", list(names), list(texts))],
                       columns=[c.split()[0] for c in lm_score.CHUNK_SCHEMA.split(", ")]).iloc[0]
    whole = list(lm_score.ask(row, 3, 7))
    some = [list(lm_score.ask(row, 3, 7, a, b)) for a, b in ((0, 1), (1, 5), (5, 7))]
    assert sum(some, []) == whole and [p for p, *_ in whole] == list(range(7)) and all(some)
    names_, n = lm_score.names_of(row), np.frombuffer(row.n, np.int64)
    assert sum(len(k) for _, _, k, _ in whole) == 8 * len(lm_score.counted(names_, n, 3)[0])
    scored = lm_score.score_documents(docs_of(spark, rows), part_bytes=3000)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "keys#" not in plan and plan.count("FileScan") == 1 + lm_score.ROUNDS  # chunks and saved answers
