"""Line dedup, SimHash and the shared linking helpers."""

import random

import pytest
from pyspark.sql import functions as F

from firmlink.llm import line_dedup, simhash
from firmlink.llm.common import Tables, components, link_buckets
from tests.conftest import SF001
from tests.llm import brute


def docs_of(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (5, 4), (9, 9)], [(i, i + 1) for i in range(40)],
                                   [(0, i) for i in range(1, 30)] + [(50, 29), (50, 60)]])
def test_components(spark, edges):
    sets = brute.Sets()
    for a, b in edges:
        if a != b:
            sets.join(a, b)
    want = {x: sets.find(x) for x in sets.up}
    got = components(spark.createDataFrame(edges, "a long, b long"), Tables(spark, "t")).collect()
    assert {r.id: r.component for r in got} == want and len(got) == len(want)


def test_components_without_the_small_path(spark, monkeypatch):
    monkeypatch.setattr("firmlink.llm.common.SMALL_EDGES", 0)
    edges = [(i, i + 1) for i in range(20)] + [(100, 101), (None, 3), (7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long"), Tables(spark, "t")).collect()
    assert {r.component for r in got} == {0, 100} and len(got) == 23


def test_link_buckets_equals_all_pairs(spark):
    rng = random.Random(3)
    members = sorted({(rng.randrange(4), rng.randrange(120)) for _ in range(250)})
    linked = lambda a, b: (a * 7 + b * 7) % 11 == 0 or abs(a - b) == 1
    sets = brute.Sets()
    for k, a in members:
        for m, b in members:
            if k == m and a < b and linked(a, b):
                sets.join(a, b)
    cond = (F.pmod(F.col("a") * 7 + F.col("b") * 7, F.lit(11)) == 0) | (F.abs(F.col("a") - F.col("b")) == 1)
    got = link_buckets(spark.createDataFrame(members, "key long, id long"), lambda p: p.where(cond), Tables(spark, "t")).collect()
    assert {r.id: r.component for r in got} == {x: sets.find(x) for x in sets.up}


def near_copy_rows(n=60, seed=5):
    """Variants of a few base lines with zero to six words replaced."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeiou") for _ in range(rng.randint(3, 9))) for _ in range(400)]
    bases = [[rng.choice(vocab) for _ in range(40)] for _ in range(3)]
    rows = []
    for d in range(n):
        lines = []
        for base in bases:
            words = list(base)
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(40)] = rng.choice(vocab)
            lines.append(" ".join(words))
        lines.append(rng.choice(["", "one", "the same short line", " ".join(rng.choice(vocab) for _ in range(12))]))
        rows.append((d, "\n".join(lines)))
    return rows


def test_line_dedup_against_all_pairs(spark):
    rows = near_copy_rows() + [(100, None), (101, ""), (102, "\n\n"), (103, "one\none\n one"), (104, "x " * 3000)]
    want = brute.line_classes(rows)
    got = line_dedup.dedup_lines(docs_of(spark, rows)).collect()
    assert {(r.doc_id, r.line_no): (r.component_doc, r.component_line) for r in got} == want
    assert sum(r.kept for r in got) == len(set(want.values()))


def test_line_dedup_on_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = brute.line_classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = {(r.doc_id, r.line_no): (r.component_doc, r.component_line) for r in line_dedup.dedup_lines(docs).collect()}
    assert got.keys() == want.keys()
    assert sum(got[k] != want[k] for k in want) <= 0.005 * len(want)  # banding may miss pairs near 0.8


def test_line_dedup_reads_every_character(spark):
    base = " ".join(f"token{i:03d}" for i in range(60))
    lines = ["https://www.a.com/x", "https://www.other.org/y", "2024-05-01T10:00:00Z", "2024-05-01T19:30:00Z", "customer_id_001",
             "customer_id_002", "customer_id_00", "https://www.a.com/x", "ab", " ab", "\U0001F600" * 11 + "ab", "\U0001F600" * 11 + "cd",
             "0" + "".join(f"{i:03d}" for i in range(100)), "9" + "".join(f"{i:03d}" for i in range(100)), base, base.replace("token030", "token031")]

    def dense(x):
        x = x.lstrip(" \t\n\x0b\f\r")
        return {x[i:i + 12] for i in range(max(1, len(x) - 11))}

    sets, grams = brute.Sets(), [dense(x) for x in lines]
    for i, a in enumerate(grams):
        for j in range(i):
            if 5 * len(a & grams[j]) >= 4 * len(a | grams[j]):
                sets.join(i, j)
    got = {r.doc_id: r.component_doc for r in line_dedup.dedup_lines(docs_of(spark, list(enumerate(lines)))).collect()}
    assert got == {i: sets.find(i) for i in range(len(lines))}
    assert {i for i in got if got[i] != i} == {7, 9, 13, 15}


def test_shingles_are_cut_without_patterns_or_strings(spark):
    lines = ["short", " \t ab", "exactly 12 ch", "twelve chars", "x " * 400, "\U0001F600" * 11 + "ab", "\U0001F600" * 13 + "é数据清洗流水线", "a\rb c" * 9]
    df = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    for size in (4, 12):
        got = {r.id: set(r.s) for r in df.select("id", line_dedup.shingle_set(F.col("line"), size).alias("s")).collect()}
        want = [brute.line_shingles(x, size) for x in lines]
        for i, a in enumerate(want):
            for j, b in enumerate(want):
                assert len(got[i] & got[j]) == len(a & b)
    signed = line_dedup.band_members(df, 12, 4, 8)
    plan = signed._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan.lower() and "lambda" not in plan.lower()
    hashes = {r.id: set(r.s) for r in df.select("id", line_dedup.shingle_set(F.col("line"), 12).alias("s")).collect()}
    again = spark.createDataFrame([(i, h) for i, s in hashes.items() for h in s], "id long, h long")
    minima = {tuple(r) for r in again.groupBy("id").agg(*line_dedup.permuted_minima(F.col("h"), 32)).select(
        "id", F.array(*[F.xxhash64(F.lit(b), *[F.col(f"m{4 * b + k}") for k in range(4)]) for b in range(8)]).cast("string")).collect()}
    assert {tuple(r) for r in signed.select("id", F.col("keys").cast("string")).collect()} == minima  # of the sets of the exact check


def test_line_dedup_repeated_and_null_ids(spark):
    rows = [(1, "a b c\nd e f"), (1, "a b c\nd e f"), (None, "a b c"), (None, None)]
    got = line_dedup.dedup_lines(docs_of(spark, rows)).collect()
    assert len(got) == 5 and sum(r.kept for r in got) == 2
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0


def test_drop_duplicate_lines_keeps_columns_and_order(spark):
    rows = [(2, "keep me\n\nshared line here", "x", 1), (1, "shared line here\nfirst", "y", 2), (3, None, None, None)]
    docs = docs_of(spark, rows, "doc_id long, text string, kept string, ord int")
    got = line_dedup.drop_duplicate_lines(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: (r.text, r.kept, r.ord) for r in got.collect()} == {
        1: ("shared line here\nfirst", "y", 2), 2: ("keep me\n", "x", 1), 3: (None, None, None)}


def test_scripts_without_spaces(spark):
    line = "数据清洗流水线需要去除重复的行以及近似重复的行内容然后再继续处理其余文档并写出结果供后面各个阶段使用直到全部完成为止"
    rows = [(1, line), (2, line[:-1] + "吧"), (3, "完全不同的另外一行文字没有任何共同之处可言")]
    got = {r.doc_id: r.component_doc for r in line_dedup.dedup_lines(docs_of(spark, rows), size=4).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_fingerprint():
    for t in ["", "a", "A b", "The quick brown fox jumps", "x y z " * 50, "Ünï cödé\tworks\vhere", None]:
        assert simhash.fingerprint(t) == brute.simhash(t)


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 5])
def test_simhash_links_equal_all_pairs(spark, bits):
    rng = random.Random(bits)
    base = [rng.getrandbits(64) for _ in range(4)]
    prints = {0, *base}
    for _ in range(150):
        x = rng.choice(base)
        for _ in range(rng.randint(0, 2 * bits + 1)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    sets = brute.Sets()
    for a in signed:
        for b in signed:
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= bits:
                sets.join(a, b)
    got = simhash.link(spark.createDataFrame([(x,) for x in signed], "id long"), bits).collect()
    assert {r.id: r.component for r in got} == {x: sets.find(x) for x in sets.up}


def test_simhash_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + [(10_000, None), (10_001, ""), (10_002, " \t")]
    got = simhash.near_duplicates(docs_of(spark, rows)).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == brute.simhash_classes(rows)


def test_drop_near_duplicates(spark):
    a, b = "the quick brown fox jumps over the lazy dog", "something else entirely here now"
    rows = [(2, a, 1), (1, a, 2), (1, a, 2), (5, a, 3), (1, b, 4), (None, "zz yy", 5), (None, "zz yy", 6), (3, None, 7), (4, "", 8)]
    docs = docs_of(spark, rows, "doc_id long, text string, fp int")
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in got.collect() if r.text) == sorted([(0, "zz yy"), (1, b), (1, a)])
    assert [r.doc_id for r in got.collect() if not r.text] == [3]
    assert simhash.drop_near_duplicates(docs_of(spark, [])).count() == 0
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_simhash_keeps_columns_with_the_names_of_its_own(spark):
    rows = [(1, "a b c d", "k", "keep me", "f"), (1, "quite another text here", "k", "keep me too", "f"), (2, "a b c d", "k", "copy", "f"),
            (3, "something else entirely now", "k", "third", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _kept string, other_text string, other_fp string")
    got = {tuple(r) for r in simhash.drop_near_duplicates(docs, shingle=3, max_bits=3).collect()}
    assert got == {r for r in rows if r[0] != 2}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_meet_removed_lines_by_one_plan_at_every_size(spark):
    line = "a line of some length that two texts hold"
    docs = docs_of(spark, [(1, f"{line}\nfirst"), (2, f"{line}\nsecond"), (3, None)])
    out = line_dedup.drop_duplicate_lines(docs)
    assert "SortMergeJoin" in _plan(out) and "BroadcastHashJoin" not in _plan(out)
    assert sorted(map(tuple, out.collect())) == [(1, f"{line}\nfirst"), (2, "second"), (3, None)]


def test_near_duplicates_are_dropped_without_a_shuffle_of_the_texts(spark, monkeypatch):
    docs = docs_of(spark, [(i, f"text {i % 5} of one word list and number {i % 5}") for i in range(12)] + [(None, "text without id")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        out = simhash.drop_near_duplicates(docs.where("doc_id IS NOT NULL"))
        assert "BroadcastHashJoin" in _plan(out) and "SortMergeJoin" not in _plan(out)
        want = sorted({r.component_id for r in simhash.near_duplicates(docs.where("doc_id IS NOT NULL")).collect()})
        assert sorted(r.doc_id for r in out.collect()) == want and len(want) < 12
        both = sorted((r.doc_id or -1 for r in simhash.drop_near_duplicates(docs).collect()))
        monkeypatch.setattr(simhash, "BROADCAST_IDS", 0)
        more = simhash.drop_near_duplicates(docs)
        assert "SortMergeJoin" in _plan(more) and sorted(r.doc_id or -1 for r in more.collect()) == both
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
