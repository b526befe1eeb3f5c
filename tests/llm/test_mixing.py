"""Curriculum mixing against a plain version."""

import hashlib
import math
import random
import re
from fractions import Fraction

from pyspark.sql import functions as F

from firmlink.llm import mixing
from firmlink.llm.common import Tables
from firmlink.llm.running import running

SCHEMA = "doc_id long, text string, source string, target string, segments string"


def docs_of(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(parts)


def targets(sizes, most=3):
    """The contract's words: share by weight, cut at the cap, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    target, full, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        over = sum(weight[s] for s in order if s not in full)
        target = {s: Fraction(most * sizes[s]) if s in full else Fraction(left * weight[s], over) for s in order}
        new = {s for s in order if s not in full and target[s] > most * sizes[s]}
        if not new:
            return target
        full |= new


def rows_of(seed=3):
    rng = random.Random(seed)
    rows, k = [], 0
    for source, n, words in (("a", 200, 40), ("b", 5, 3), (None, 30, 20), ("", 12, 9), ("É", 7, 400), ("z", 1, 0), ("b\n", 90, 30)):
        for _ in range(n):
            rows.append((k, rng.choice([" ", "\t", "\n  "]).join("x" * rng.randint(1, 3) for _ in range(rng.randint(0, words))), source))
            k += 1
    return rows + [(k, None, "a"), (5, "same id", "a"), (5, "same id", "a"), (None, "no id", "b"), (k + 1, "w " * 30_000, "a")]


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_against_a_plain_version(spark):
    rows = rows_of()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size_of(text)
    want = targets(sizes)
    expected = []
    for s in sizes:
        mine = sorted(((hashlib.md5(f"0:{'' if d is None else d}".encode()).hexdigest(), size_of(t), d) for d, t, x in rows if x == s))
        take, at = round(want[s]), 0
        for _, size, d in mine:
            taken = sum(max(0, min(size, take - (e * sizes[s] + at))) for e in range(4))
            expected.append((d, s, size, sizes[s], float(want[s]), taken))
            at += size
    for parts in (1, 7):
        got = mixing.mix(docs_of(spark, rows, parts)).collect()
        key = lambda r: (str(r[0]), str(r[1]), *r[2:])
        out = sorted(((r.doc_id, r.source, r.size, r.source_size, r.target, r.taken) for r in got), key=key)
        for a, b in zip(out, sorted(expected, key=key), strict=True):
            assert a[:4] == b[:4] and a[5] == b[5] and math.isclose(a[4], b[4], rel_tol=1e-12), (a, b)
        for s in sizes:
            assert abs(sum(r.taken for r in got if r.source == s) - want[s]) <= 1
        assert all(r.taken <= 3 * r.size for r in got)


def test_positions_invert_the_demand(spark):
    """The words taken up to a position are the source's demand up to that time."""
    ramp = lambda rank: mixing.knots((0.0, 0.0), (0.25, 2.0), (0.75, 2.0), (1.0, 0.5))

    def demand(t):
        area = lambda t: (4 * t * t if t < .25 else .25 + 2 * (t - .25) if t < .75 else
                          1.25 + 2 * (t - .75) - 3 * (t - .75) ** 2)
        return area(t) / area(1.0)

    mixed = mixing.mix(docs_of(spark, rows_of(5)), schedule=ramp, seed=9)
    order = mixing.training_order(mixed)
    got = order.collect()
    assert [r.position for r in got] == sorted(r.position for r in got)
    done = {}
    for r in sorted(got, key=lambda r: (str(r.source), r.position, r.repeat, r.start)):
        before = done.get(r.source, 0)
        assert before == r.repeat * r.source_size + r.start
        assert abs(demand(r.position) - before / r.take) < 1e-9
        done[r.source] = before + r.words
    assert done == {r.source: r["take"] for r in mixed.where("take > 0").select("source", "take").distinct().collect()}
    per_doc = {}
    for r in got:
        per_doc[r.doc_id, r.start, r.source] = per_doc.get((r.doc_id, r.start, r.source), 0) + r.words
    assert per_doc == {(r.doc_id, r.start, r.source): r.taken for r in mixed.where("taken > 0").collect()}


def test_shares_change_over_time(spark):
    """Two equal sources, one falling and one rising: the first half reads more of the first."""
    rows = [(k, "w " * 10, "ab"[k % 2]) for k in range(4000)]
    falls = lambda rank: mixing.knots((0.0, F.when(rank == 0, 2.0).otherwise(0.0)), (1.0, F.when(rank == 0, 0.0).otherwise(2.0)))
    got = mixing.training_order(mixing.mix(docs_of(spark, rows), schedule=falls)).where("position < 0.5").groupBy("source").count()
    n = {r["source"]: r["count"] for r in got.collect()}
    assert abs(n["a"] - 1500) <= 1 and abs(n["b"] - 500) <= 1


def test_empty_and_wordless(spark):
    assert mixing.mix(docs_of(spark, [])).count() == 0
    got = mixing.by_position(mixing.mix(docs_of(spark, [(1, None, None), (2, "", "a"), (3, " \t", None)]))).collect()
    assert {(r.doc_id, r.size, r.source_size, r.target, r.taken, r.position) for r in got} == {
        (1, 0, 0, 0.0, 0, None), (2, 0, 0, 0.0, 0, None), (3, 0, 0, 0.0, 0, None)}


def test_running_over_many_parts(spark):
    """A hot group over many tasks, a null group and ties."""
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), k, rng.randint(-5, 5)) for k in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables = Tables(spark, "test")
        df = tables.save(spark.createDataFrame(rows, "g int, k long, part long"))
        got = running(df, "g", [F.col("k").desc()], {"s": ("sum", F.col("part")), "x": ("xor", F.col("k"))}, tables).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sums, xors = {}, {}
    for g, k, v in sorted(rows, key=lambda r: -r[1]):
        sums[g], xors[g] = sums.get(g, 0) + v, xors.get(g, 0) ^ k
        rows[k] = (g, k, v, sums[g], xors[g])
    assert sorted(map(tuple, got), key=lambda r: r[1]) == rows
