"""Language ID, toxicity, top-k search, URL filters, and the pipeline."""

import random

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from firmlink.llm import lang_id, topk, toxicity, url_filter
from firmlink.llm.queries import ORACLES, QUERIES
from tests.conftest import SF01, SF001
from tests.llm import brute
from tests.llm.test_near_duplicates import docs_of
from tests.llm.test_text_operators import check_packing
from tools.check_oracle import digest


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    assert digest(QUERIES[name](spark, SF001).toPandas())[1] == digest(con.sql(ORACLES[name]).df())[1]


def test_language_held_out_accuracy(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op6_language_id"](spark, SF01).collect()
    assert len(got) == len(langs) and all(r.held_out == (brute.crc_mod(r.doc_id, 5) == 0) for r in got)
    held = [r for r in got if r.held_out and langs[r.doc_id]]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges(spark):
    rows = [(i, w * 5, c) for i in range(1, 30) for w, c in (("the cat and the dog ", "en"), ("der hund und die katze ", "de"))]
    train = docs_of(spark, rows + [(None, "x", "en"), (99, None, "fr"), (98, "123", "fr"), (97, "abc", None)], "doc_id long, text string, lang string")
    model = lang_id.train(train)
    assert model.langs == ["de", "en"]
    docs = docs_of(spark, [(1, None, 1), (2, "", 2), (3, "12 ... !", 3), (4, "the dog", 4), (4, "the dog", 4), (None, "und die katze" * 4000, 5)],
                   "doc_id long, text string, score int")
    got = lang_id.identify(docs, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got.collect()) == [(0, "de"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en")]
    kept = lang_id.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == 3
    nothing = lang_id.train(docs_of(spark, [], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in lang_id.identify(docs, nothing).collect()} == {"und"}
    assert lang_id.identify(docs_of(spark, []), model).count() == 0


def test_language_of_texts_with_very_many_ngrams(spark):
    rng = random.Random(6)
    text = lambda a, n: "".join(chr(0x4E00 + a + rng.randrange(3000)) for _ in range(n))
    rows = [(i, text(a, 300), c) for i in range(60) for a, c in ((0, "a"), (1500, "b"))]
    schema = "doc_id long, text string, lang string"
    long = [text(0, 200_000), text(1500, 200_000), text(0, 2_000), text(1500, 2_000)]
    whole = docs_of(spark, [(i, long[i % 2], "ab"[i % 2]) for i in range(4)], schema)
    for train in (docs_of(spark, rows, schema), whole):
        assert lang_id.train(train).predict(long)[0] == ["a", "b", "a", "b"]
    parts = lang_id.segments(long[0])
    assert {g for p in parts for g in (p[i:i + 4] for i in range(len(p) - 3))} == {long[0][i:i + 4] for i in range(len(long[0]) - 3)}
    assert max(lang_id.presence(parts).mean(1)) < 0.2


def test_language_stage_rejects_only_texts_without_a_letter(spark):
    rows = [(i, "some words that every language has", f"l{i % 20}") for i in range(60)] + [(100, "12 ...", "l1"), (101, None, "l2")]
    docs = docs_of(spark, rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, docs, None).collect()} == set(range(60))


def test_presence_kernel_is_folded_exactly():
    texts = ["the cat", "a dog and a cat", "chien et chat", "le chat"]
    bits = np.packbits(lang_id.presence(texts), axis=1)
    model = lang_id.fit(bits, ["en", "en", "fr", "fr"])
    m = lang_id.presence(texts).astype(float)
    n = m / np.sqrt(m.sum(1, keepdims=True))
    kernel = n @ n.T
    w = np.linalg.solve(kernel + lang_id.RIDGE * 4 * np.eye(4), np.array([[1, -1], [1, -1], [-1, 1], [-1, 1]], float))
    assert np.allclose(n @ model.weights, kernel @ w, atol=1e-3)


def toxic_rows(n=240, seed=2):
    rng = random.Random(seed)
    syllables = ["ta", "re", "no", "li", "mu", "so", "ke", "ba"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows = []
    for d in range(n):
        words = [word() for _ in range(rng.randint(20, 150))]
        bad = d % 4 == 0
        for _ in range(3 if bad else 0):
            words[rng.randrange(len(words))] = rng.choice(["idiot", "scum", "vequ" + word()])
        rows.append((d, " ".join(words), int(bad)))
    return rows


def test_toxicity_learns_words_and_character_patterns(spark):
    rows = toxic_rows()
    labelled = docs_of(spark, rows, "doc_id long, text string, toxic int").where(~toxicity.held_out_fold())
    net = toxicity.train(labelled)
    docs = docs_of(spark, [r[:2] for r in rows if brute.crc_mod(r[0], 3) == 1] + [(1000, None), (1001, ""), (1002, "ta re " * 5000 + "idiot scum")])
    got = {r.doc_id: r.score for r in toxicity.score(docs, net).collect()}
    held = [r for r in rows if brute.crc_mod(r[0], 3) == 1]
    assert sum((got[d] >= 0.7) == bool(y) for d, _, y in held) >= 0.9 * len(held)
    assert got[1000] == got[1001] == 0 and got[1002] > 0.5


def test_toxicity_edges(spark):
    empty = toxicity.train(docs_of(spark, [(1, None, 1), (2, "a", None)], "doc_id long, text string, toxic int"))
    docs = docs_of(spark, [(1, "a b", 1), (None, None, 2), (1, "a b", 1)], "doc_id long, text string, Score int")
    got = toxicity.score(docs, empty)
    assert got.columns == ["doc_id", "text", "score"]
    assert all(0 <= r.score <= 1 for r in got.collect()) and got.count() == 3
    assert toxicity.score(docs_of(spark, []), empty).count() == 0


def test_toxicity_gradients():
    net = toxicity.fit(["good words here are many", "bad scum words here"] * 3, np.array([0, 1] * 3), epochs=1)
    words = ["good", "scum", "here"]
    idx = np.full((2, toxicity.WINDOW), -1)
    idx[0, :3], idx[1, :2] = [0, 1, 2], [2, 1]
    x, _ = net.features(words)
    x = x.astype(np.float64)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    toxicity_loss = lambda: float(net.run(x, idx) @ np.array([0.3, -0.7]))
    _, kept = net.run(x, idx, keep=True)
    g, dx = net.backward(x, kept, np.array([0.3, -0.7]))
    rng = np.random.default_rng(0)
    for name in ("out", "attend", "w0", "w1", "u0", "u1", "b0", "b1"):
        at = tuple(rng.integers(s) for s in net.p[name].shape)
        old, eps = net.p[name][at], 1e-3
        net.p[name][at] = old + eps
        up = toxicity_loss()
        net.p[name][at] = old - eps
        down = toxicity_loss()
        net.p[name][at] = old
        assert np.isclose((up - down) / (2 * eps), g[name][at], rtol=2e-2, atol=2e-4), name
    old = x[1, 4]
    x[1, 4] = old + 1e-3
    up = toxicity_loss()
    x[1, 4] = old - 1e-3
    assert np.isclose((up - toxicity_loss()) / 2e-3, dx[1, 4], rtol=2e-2, atol=2e-4)


def test_windows_cover_and_overlap():
    for n in (1, 31, 32, 33, 48, 100, 1000):
        w = toxicity.windows(n)
        assert w[0] == 0 and (n <= toxicity.WINDOW or w[-1] + toxicity.WINDOW == n)
        assert all(b - a <= toxicity.STRIDE for a, b in zip(w, w[1:]))


def top_brute(rows, queries, k):
    fine = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in fine:
        if q in queries:
            score = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q and len(w) == len(v))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(score)]
    return sorted(out)


def test_top_k_edges(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 0.25]) for _ in range(12)]) for i in range(150)]
    rows += [(500, None), (600, [None] * 12), (700, [float("nan")] * 12), (800, [float("inf")] + [0.0] * 11), (900, [1.0] * 3), (901, [1.0] * 3),
             (None, [1.0] * 12), (1000, [1e6] * 12), (1100, [-1e6] * 12), (1200, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = top_brute(rows, {i for i, _ in rows if i is not None and i % 100 == 0}, 10)
    for kw in ({}, {"rows_per_block": 16, "queries_per_block": 2, "dim_block": 5}):
        got = topk.top_k(df, df.where("vec_id % 100 = 0"), 10, **kw).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [w for w in want if w[0] != 1200]
    assert topk.top_k(df.limit(0), df.limit(0), 10).count() == 0


def test_top_k_in_passes(spark, monkeypatch):
    monkeypatch.setattr(topk, "BROADCAST_BYTES", 1)
    rows = [(i, [float((i * j) % 7 - 3) for j in range(1, 9)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id % 20 = 0"), 3, queries_per_block=1).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == top_brute(rows, {0, 20, 40}, 3)


def test_branch_and_bound_drops_candidates():
    ids = np.arange(2000)
    cells = np.zeros((16, 2000), np.int64)
    cells[0] = np.arange(2000)
    cells[1:] = 1
    best = topk.Best(np.array([-1]), np.ones((16, 1), np.int64), 5)
    best.offer(slice(0, 1), ids[1000:], cells[:, 1000:], 4)
    assert best.offer(slice(0, 1), ids[:1000], cells[:, :1000], 4) < 100
    assert best.id[0].tolist() == [1999, 1998, 1997, 1996, 1995]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_url_rules_and_parts(spark):
    rows = [(1, "http://A.Net/x?q#f", None), (2, "https://www.example.net/en/1", ""), (3, "http://example.net/enx", None), (4, "http://b.org/fr/", None),
            (5, "http://borg/fr/", None), (6, None, None), (7, "no scheme/net/", None), (8, "http://net", None), (9, "http://sub.example.com/de/x", None),
            (10, "http://example.com/DE/x", None), (11, "x://y.net?u=http://a.org/fr/", None), (11, "http://notnet/", None)]
    got = {(r.page_id, r.host): (r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages(spark, rows)).collect()}
    assert got == {
        (1, "a.net"): ("/x", "net/", "block"), (2, "www.example.net"): ("/en/1", "example.net/en/", "allow"),
        (3, "example.net"): ("/enx", "net/", "block"), (4, "b.org"): ("/fr/", "org/fr/", "allow"), (5, "borg"): ("/fr/", None, "allow"),
        (6, ""): ("", None, "allow"), (7, ""): ("", None, "allow"), (8, "net"): ("", None, "allow"),
        (9, "sub.example.com"): ("/de/x", "example.com/de/", "block"), (10, "example.com"): ("/DE/x", None, "allow"),
        (11, "y.net"): ("", None, "allow"), (11, "notnet"): ("/", None, "allow")}


def test_url_redirect_equivalence(spark):
    canon = '<head><LINK href="%s" rel="canonical"></head>'
    rows = [(1, "http://a.io/1", canon % "http://bad.net/x"), (2, "http://b.io/2", canon % "//a.io/1"), (3, "http://c.org/fr/3", canon % "http://a.io/1#top"),
            (4, "http://d.io/dir/4", '<meta http-equiv=refresh content="0; url=other">'), (5, "http://d.io/dir/other", None), (6, "http://e.io/", canon % "/self"),
            (7, "http://f.io/7", None), (7, "http://f.io/7", None), (8, "http://A.io/1#frag", None)]
    got = url_filter.filter_urls(pages(spark, rows))
    assert sorted((r.page_id, r.verdict) for r in got.collect()) == [
        (1, "block"), (2, "block"), (3, "allow"), (4, "allow"), (5, "allow"), (6, "allow"), (7, "allow"), (7, "allow"), (8, "block")]
    more = spark.createDataFrame([("http://d.io/dir/other", "http://www.example.com/de/"), ("http://f.io/7", "http://e.io/")], "src string, dst string")
    got = url_filter.filter_urls(pages(spark, rows).withColumn("verdict", F.col("url")), redirects=more)
    assert {r.page_id: r.verdict for r in got.collect()} == {1: "block", 2: "block", 3: "allow", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "block"}
    assert url_filter.filter_urls(pages(spark, [])).count() == 0


def test_link_targets_follow_the_url_standard(spark):
    base = "http://a/b/c/d;p?q"  # the examples of RFC 3986, 5.4, that have a host
    want = {"g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g",
            "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q", "g#s": "http://a/b/c/g",
            ";x": "http://a/b/c/;x", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/",
            "../g": "http://a/b/g", "../..": "http://a/", "../../g": "http://a/g", "../../../g": "http://a/g", "/./g": "http://a/g",
            "/../g": "http://a/g", "g.": "http://a/b/c/g.", "..g": "http://a/b/c/..g", "./g/.": "http://a/b/c/g/",
            "g/../h": "http://a/b/c/h", "g;x=1/../y": "http://a/b/c/y", "g?y/../x": "http://a/b/c/g?y/../x", "https://X/./y": "https://x/y",
            "/x?ref=https://foo.net/": "http://a/x?ref=https://foo.net/", "x/y://z": "http://a/b/c/x/y://z"}
    links = spark.createDataFrame([(h,) for h in want], "href string")
    got = links.select("href", url_filter.url_key(url_filter.resolve(F.lit(base), F.col("href"))).alias("u")).collect()
    assert {r.href: r.u for r in got} == want


def test_block_decisions_reach_resolved_links_only(spark):
    link = '<link rel="canonical" href="%s">'
    pages = docs_of(spark, [
        (1, "https://a.io/x", link % "/x?ref=https://foo.net/"), (2, "https://example.com/en/x", link % "../de/x"),
        (3, "https://b.io/list", link % "?p=2"), (4, "https://b.io/list?p=2", link % "https://bad.net/"), (5, "https://b.io/", "")],
        "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages).collect()}
    assert got == {1: "allow", 2: "block", 3: "block", 4: "block", 5: "allow"}


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = lang_id.train(docs)
    rows = {r.doc_id: r.text for r in docs.collect()}
    pred, score = model.predict([rows[d] for d in sorted(rows)])
    rows = {d: rows[d] for d, p, s in zip(sorted(rows), pred, score) if p != "und" and s >= corpus_pipeline.MIN_LANGUAGE_SCORE}
    classes = brute.line_classes(list(rows.items()))
    gone = {k for k, v in classes.items() if k != v}
    rows = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) if any(g[0] == d for g in gone) else t for d, t in rows.items()}
    groups = brute.simhash_classes(list(rows.items()))
    rows = {d: t for d, t in rows.items() if groups[d][1] == d}
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    judged = brute.contaminated(list(rows.items()), items)
    rows = {d: t for d, t in rows.items() if not judged[d][3]}

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
    step = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, SF001)
        assert step.columns == docs.columns
    assert {r.doc_id: r.text for r in step.collect()} == rows
    got = corpus_pipeline.run(spark, SF001).collect()
    assert {r.doc_id for r in got} == set(rows)
    used, least = check_packing(list(rows.items()), got, 1024)
    assert used <= least + 3
