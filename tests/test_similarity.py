"""Similarity UDF equals difflib; bounds never undercut the ratio; the
prefix-filtered candidate set equals brute force."""

import random
from difflib import SequenceMatcher

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from firmlink.config import MatchConfig
from firmlink.functions.similarity import (
    char_places,
    char_tokens,
    common_subsequence,
    length_bound,
    min_overlap_py,
    multiset_bound,
    ratio_udf,
    ratios,
)
from firmlink.operators.match import candidate_pairs
from tests.conftest import SF01

ALPHA = "abcde &0"


def _pairs(n, seed, alpha=ALPHA, lo=1, hi=30):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(alpha) for _ in range(rnd.randint(lo, hi)))
    return [(word(), word()) for _ in range(n)]


def test_udf_equals_difflib_and_bounds_hold(spark):
    pairs = _pairs(500, 1) + [("customer 000000001", "customer 000000002"), ("a" * 250, "a" * 240 + "b" * 10)]
    df = spark.createDataFrame(pairs, "a string, b string")
    la, lb = F.length("a"), F.length("b")
    rows = df.select(
        "a", "b", ratio_udf("a", "b").alias("r"),
        length_bound(la, lb).alias("lb"),
        multiset_bound(char_tokens("a"), char_tokens("b"), la, lb).alias("mb"), F.levenshtein("a", "b").alias("lev"),
    ).collect()
    for r in rows:
        assert r.r == SequenceMatcher(None, r.a, r.b).ratio()
        assert r.lb >= r.r - 1e-12 and r.mb >= r.r - 1e-12
        assert r.lb >= r.mb - 1e-12
        assert r.lev <= (1 - r.r) * (len(r.a) + len(r.b)) + 1e-9


@settings(max_examples=300, deadline=None)
@given(st.integers(min_value=1, max_value=400), st.integers(min_value=1, max_value=400),
       st.sampled_from([0.3, 0.5, 0.7, 0.8, 0.85, 0.9, 0.95, 1.0]))
def test_min_overlap_is_safe(la, lb, lo):
    # whenever a pair of these lengths can reach lo, the overlap it needs is
    # at least each side's min_overlap, so prefix filtering loses nothing
    need = lo * (la + lb) / 2.0
    if need <= min(la, lb) + 1e-12:
        need_int = -(-need // 1) if abs(need - round(need)) > 1e-9 else round(need)
        assert min_overlap_py(la, lo) <= need_int
        assert min_overlap_py(lb, lo) <= need_int


def _brute(reg, cc, cfg):
    out = set()
    for a in reg:
        for b in cc:
            if a == b or a[: cfg.block_chars] != b[: cfg.block_chars]:
                continue
            la, lb = len(a), len(b)
            if 2 * min(la, lb) / (la + lb) < cfg.lo:
                continue
            ov = sum(min(a.count(ch), b.count(ch)) for ch in set(a))
            if 2 * ov / (la + lb) >= cfg.lo:
                out.add((a, b))
    return out


def _cands(spark, reg, cc, cfg):
    r = spark.createDataFrame([(n,) for n in reg], "norm string")
    c = spark.createDataFrame([(n,) for n in cc], "norm string")
    return {(x.r_norm, x.c_norm) for x in candidate_pairs(r, c, cfg).collect()}


def test_candidates_equal_brute_force_hot_block(spark):
    # one block holds most names (all start with "aaa"), as a skewed key would
    rnd = random.Random(7)
    names = lambda k: sorted({"aaa" + "".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 12))) for _ in range(k)})
    reg, cc = names(150), names(150)
    for lo in (0.5, 0.8, 0.95):
        cfg = MatchConfig(lo=lo, hi=max(lo, 0.95))
        assert _cands(spark, reg, cc, cfg) == _brute(reg, cc, cfg)
    for bc in (1, 2, 4):
        cfg = MatchConfig(block_chars=bc)
        assert _cands(spark, reg, cc, cfg) == _brute(reg, cc, cfg)


def test_candidates_equal_brute_force_fixture(spark):
    from firmlink.fixtures import unify_inputs
    from firmlink.functions.text import norm_name

    reg, cc = unify_inputs(spark, SF01)
    rn = sorted({r.n for r in reg.select(norm_name("entity_name").alias("n")).collect() if r.n})
    cn = sorted({r.n for r in cc.select(norm_name("extracted_name").alias("n")).collect() if r.n})
    cfg = MatchConfig()
    got = _cands(spark, rn, cn, cfg)
    assert got == _brute(rn, cn, cfg)
    assert len(got) > 50


def test_hot_block_with_rare_key_letters_is_not_all_pairs(spark):
    # 400 names in block "qxz" (letters that occur nowhere else) with random
    # suffixes, plus filler names elsewhere: the key tokens are the rarest,
    # yet the join must not pair the whole block
    from firmlink.operators import match as M

    rnd = random.Random(3)
    letters = "abcdefghijklmnoprstuvwy"
    hot = sorted({"qxz " + "".join(rnd.choice(letters) for _ in range(14)) for _ in range(400)})
    filler = sorted({"".join(rnd.choice("eas") for _ in range(12)) for _ in range(400)})
    reg, cc = hot[:200] + filler[:200], hot[200:] + filler[200:]
    cfg = MatchConfig()
    rdf = spark.createDataFrame([(n,) for n in reg], "norm string")
    cdf = spark.createDataFrame([(n,) for n in cc], "norm string")
    r, c = M.name_table(rdf, cfg, "r"), M.name_table(cdf, cfg, "c")
    joined = M._token_pairs(r, c, cfg).count()
    block_pairs = 200 * 200
    # rows count duplicates of one pair
    assert joined < block_pairs * 0.6
    got = _cands(spark, reg, cc, cfg)
    assert got == _brute(reg, cc, cfg)
    assert len([p for p in got if p[0].startswith("qxz")]) < block_pairs // 100


def _table_lcs(a, b):
    row = [0] * (len(b) + 1)
    for ch in a:
        new = [0]
        for j, other in enumerate(b):
            new.append(row[j] + 1 if ch == other else max(new[j], row[j + 1]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcé𝄞 ", max_size=90), st.text(alphabet="abcé𝄞 ", max_size=90))
def test_common_subsequence_equals_the_table_and_bounds_the_ratio(a, b):
    n = common_subsequence(a, char_places(b), len(b))
    assert n == _table_lcs(a, b)
    if a and b:
        assert 2 * n / (len(a) + len(b)) >= SequenceMatcher(None, a, b).ratio() - 1e-12


def test_subsequence_bound_keeps_scores_and_spares_the_matcher():
    # repeated and popular characters too: the matcher treats those of texts of
    # 200 characters and more apart
    pairs = _pairs(3000, 11, alpha="abcdef") + _pairs(30, 12, alpha="ab", lo=190, hi=260)
    pairs += [(a, a[:-1] + "x") for a, _ in pairs[:300]] + [("", "a"), ("a", ""), (None, "a"), ("same", "same")] * 2
    a, b = (pd.Series([p[i] for p in pairs], dtype=object) for i in (0, 1))
    plain = ratios(a, b)
    for lo in (0.5, 0.8, 0.95, 1.0):
        fed = []

        def score(matcher):
            fed.append(1)
            return matcher.ratio()

        bounded = ratios(a, b, lo, score)
        want = plain.where(plain >= lo, 0.0)
        assert (bounded.where(bounded >= lo, 0.0) == want).all()
        reached = int((plain >= lo).sum())
        assert reached <= len(fed) < len(pairs) - 8
        if lo == 0.8:
            assert len(fed) < 3 * reached


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcé𝄞 ", min_size=1, max_size=150), min_size=1, max_size=8, unique=True),
       st.lists(st.text(alphabet="abcé𝄞 ", min_size=1, max_size=150), min_size=1, max_size=8, unique=True))
def test_tile_bounds_equal_the_plain_ones(a, b):
    import numpy as np

    from firmlink.functions.similarity import NameTile

    tile = NameTile(a, b)
    tile.PAIRS, tile.SUBSEQUENCES = 4, 3
    got = {(i, j): n for s in tile.overlapping(0.6) for i, j, n in zip(*(x.tolist() for x in s))}
    plain = {}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            n = sum(min(x.count(ch), y.count(ch)) for ch in set(x))
            if 2.0 * n / (len(x) + len(y)) >= 0.6:
                plain[i, j] = n
    assert got == plain
    i, j = (v.ravel() for v in np.indices((len(a), len(b))))
    want = [common_subsequence(a[x], char_places(b[y]), len(b[y])) for x, y in zip(i, j)]
    assert tile.subsequences(i, j).tolist() == want


def _join_rows(node):
    """Rows out of the joins of an executed plan."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _join_rows(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return _join_rows(node.plan())
    metric = node.metrics().get("numOutputRows")
    own = metric.get().value() if "Join" in name and metric.isDefined() else 0
    return own + sum(_join_rows(node.children().apply(k)) for k in range(node.children().size()))


def test_a_hot_block_makes_no_row_for_a_pair_below_the_bounds(spark, monkeypatch):
    from firmlink.operators import match as M

    rnd = random.Random(5)
    names = lambda k: sorted({"the " + "".join(rnd.choice("etaonishr d") for _ in range(rnd.randint(20, 50))) for _ in range(k)})
    reg, cc = names(300), names(300)
    cc += [n[:-2] for n in reg[:40]]
    dfs = [spark.createDataFrame([(n,) for n in ns], "norm string") for ns in (reg, cc)]
    cfg = MatchConfig()
    brute = _brute(reg, cc, cfg)
    pairs = candidate_pairs(*dfs, cfg)
    assert {(x.r_norm, x.c_norm) for x in pairs.collect()} == brute
    # a row of the joins is a name or a tile, no pair of names
    assert _join_rows(pairs._jdf.queryExecution().executedPlan()) < 2 * (len(reg) + len(cc)) < len(brute)
    # many chunks of few names, and of few characters
    for room in ({"CHUNK_NAMES": 32}, {"CHUNK_CHARS": 1 << 9}):
        with monkeypatch.context() as m:
            for k, v in room.items():
                m.setattr(M, k, v)
            rows = [(x.r_norm, x.c_norm) for x in candidate_pairs(*dfs, cfg).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == brute
    near = {(x.r_norm, x.c_norm) for x in candidate_pairs(*dfs, cfg, subsequence=True).collect()}
    scored = {(a, b) for a, b in brute if SequenceMatcher(None, a, b).ratio() >= cfg.lo}
    assert len(scored) >= 40 and scored <= near < brute
