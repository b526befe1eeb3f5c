"""Toxicity scores from a bidirectional GRU with attention pooling.

A text is a sequence of words; a word enters the network as a vector of word
inputs (an embedding and a class weight of the word, for words of the training
vocabulary) and character inputs (the mean embedding, mean and largest class
weight of its hashed character n-grams with boundary marks, for every word).
The network reads overlapping windows of ``WINDOW`` words, ``STRIDE`` apart, over
the whole text; attention pools the hidden states of a window, a logistic unit
scores it, and a text's score is that of its highest window.

Training is plain numpy with multiple-instance labels: the label of a text is
known, not which window earns it, so each epoch trains on the windows that score
highest at its start. It uses a bounded sample of labelled texts
(``SAMPLE_TOXIC``, ``SAMPLE_CLEAN``, texts up to ``SAMPLE_CHARS`` characters);
scoring has no such bound.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlink.llm.common import free_name, id_text

WINDOW, STRIDE = 32, 16
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 500, 1000, 10_000
CELLS = 1 << 16
WORD_DIM, CHAR_DIM, HIDDEN = 4, 6, 8
MIN_DF_WORD, MIN_DF_GRAM = 3, 5
EPOCHS, RATE = 5, 0.01
WORDS_AT_ONCE, WINDOWS_AT_ONCE = 1_500_000, 1024
WORD = re.compile(r"\w+")


def gram_table(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the character n-grams (3 to 5, with boundary marks) of each
    word, flat, and each word's first position in it."""
    marked = [f"^{w}$" for w in words]
    n = np.array([len(w) for w in marked], np.int64)
    a = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    start = np.cumsum(n) - n
    left = np.repeat(start + n, n) - np.arange(len(a))
    cells, owner = [], []
    who = np.repeat(np.arange(len(words)), n)
    h = np.zeros(len(a), np.uint32)
    for k in range(1, 6):
        h = h[: len(a) - k + 1] * np.uint32(0x01000193) + a[k - 1:] + np.uint32(k)
        if k >= 3:
            ok = np.flatnonzero(left[: len(h)] >= k)
            x = h[ok] * np.uint32(0x9E3779B1)
            cells.append((x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(16))
            owner.append(who[ok])
    cells, owner = np.concatenate(cells), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return cells[order].astype(np.int64), np.searchsorted(owner[order], np.arange(len(words)))


def windows(n: int) -> np.ndarray:
    """First words of the overlapping windows that cover ``n`` words; the last
    one ends at the last word. One window for a text of up to WINDOW words."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)


def sigmoid(x):
    """Logistic function; saturates where the exponential overflows."""
    with np.errstate(over="ignore"):
        y = np.exp(-x)
    y += 1
    return np.reciprocal(y, out=y)


@dataclass
class Net:
    """Parameters ``p`` by name, and the training vocabulary."""

    vocab: dict
    p: dict

    def features(self, words: list[str]):
        """Input vectors of distinct words, and what the backward pass needs."""
        p = self.p
        at = np.array([self.vocab.get(w, 0) for w in words], np.int64)
        cells, first = gram_table(words)
        num = np.diff(np.append(first, len(cells)))[:, None].astype(np.float32)
        weight = p["gram_weight"][cells]
        x = np.concatenate([
            p["word_weight"][at][:, None], np.maximum.reduceat(weight, first)[:, None],
            np.add.reduceat(weight, first)[:, None] / num,
            p["word"][at], np.add.reduceat(p["gram"][cells], first) / num], axis=1)
        return x, (at, cells, num[:, 0])

    def run(self, x_of_word: np.ndarray, idx: np.ndarray, keep: bool = False):
        """Logits of windows ``idx`` (windows x WINDOW word numbers, -1 beyond
        the end). With ``keep`` also the values for the backward pass."""
        p, (n, t_len), h_dim = self.p, idx.shape, HIDDEN
        mask = (idx >= 0).astype(np.float32)
        short = not mask.all()
        at = np.maximum(idx, 0)
        states, cache = np.empty((n, t_len, 2 * h_dim), np.float32), []
        for d, order in ((0, range(t_len)), (1, range(t_len - 1, -1, -1))):
            u = p[f"u{d}"]
            proj = x_of_word @ p[f"w{d}"] + p[f"b{d}"]
            h = np.zeros((n, h_dim), np.float32)
            for t in order:
                a = proj[at[:, t]]
                zr = sigmoid(a[:, :2 * h_dim] + h @ u[:, :2 * h_dim])
                z, r = zr[:, :h_dim], zr[:, h_dim:]
                hu = h @ u[:, 2 * h_dim:]
                c = np.tanh(a[:, 2 * h_dim:] + r * hu)
                new = c + z * (h - c)
                if short:
                    new = h + mask[:, t:t + 1] * (new - h)
                if keep:
                    cache.append((d, t, h, z, r, hu, c))
                states[:, t, d * h_dim:(d + 1) * h_dim] = h = new
        e = states @ p["attend"] + (mask - 1) * 50
        e = np.exp(e - e.max(1, keepdims=True))
        alpha = e / e.sum(1, keepdims=True)
        pooled = np.einsum("nt,ntk->nk", alpha, states)
        logit = pooled @ p["out"] + p["bias"]
        return (logit, (mask, at, states, alpha, pooled, cache)) if keep else logit

    def backward(self, x_of_word, kept, grad_logit):
        """Gradients by name, and with respect to the input vectors."""
        p, h_dim = self.p, HIDDEN
        mask, at, states, alpha, pooled, cache = kept
        g = {"out": pooled.T @ grad_logit, "bias": grad_logit.sum(keepdims=True)}
        d_pool = grad_logit[:, None] * p["out"]
        d_alpha = np.einsum("nk,ntk->nt", d_pool, states)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(1, keepdims=True))
        g["attend"] = np.einsum("nt,ntk->k", d_e, states)
        d_states = alpha[:, :, None] * d_pool[:, None, :] + d_e[:, :, None] * p["attend"]
        dx = np.zeros_like(x_of_word)
        for d in (0, 1):
            u, w = p[f"u{d}"], p[f"w{d}"]
            g[f"u{d}"], d_proj = np.zeros_like(u), np.zeros((len(x_of_word), 3 * h_dim), np.float32)
            carry = np.zeros((len(grad_logit), h_dim), np.float32)
            for _, t, h, z, r, hu, c in reversed([x for x in cache if x[0] == d]):
                total = carry + d_states[:, t, d * h_dim:(d + 1) * h_dim]
                m = mask[:, t:t + 1]
                new = total * m
                dc = new * (1 - z) * (1 - c * c)
                dz = new * (h - c) * z * (1 - z)
                dr = dc * hu * r * (1 - r)
                da = np.concatenate([dz, dr, dc], axis=1)
                du = np.concatenate([dz, dr, dc * r], axis=1)
                g[f"u{d}"] += h.T @ du
                carry = total * (1 - m) + new * z + du @ u.T
                np.add.at(d_proj, at[:, t], da)
            g[f"w{d}"], g[f"b{d}"] = x_of_word.T @ d_proj, d_proj.sum(0)
            dx += d_proj @ w.T
        return g, dx


def class_weight(df_toxic, df_clean, n_toxic, n_clean, min_df):
    """Smoothed log ratio of document frequencies, within -1 and 1; 0 for what
    fewer than ``min_df`` training texts hold."""
    w = np.log((df_toxic + 0.5) / (n_toxic + 1)) - np.log((df_clean + 0.5) / (n_clean + 1))
    return np.where(df_toxic + df_clean >= min_df, np.clip(w, -4, 4) / 4, 0).astype(np.float32)


def tokens(texts) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of a batch, the word numbers of all texts joined, and the
    number of words of each text. Null texts have none."""
    words = [WORD.findall(t.lower()) if t else [] for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    codes, uniques = pd.factorize(np.array([w for ws in words for w in ws], dtype=object))
    return list(uniques), codes, n


def window_rows(codes, n):
    """Windows (word numbers, -1 padded) of all texts with words, and the text
    each belongs to."""
    first = np.cumsum(n) - n
    begin, owner = [], []
    for i in np.flatnonzero(n):
        w = windows(int(n[i]))
        begin.append(first[i] + w)
        owner.append(np.full(len(w), i))
    if not begin:
        return np.zeros((0, WINDOW), np.int64), np.zeros(0, np.int64)
    begin, owner = np.concatenate(begin), np.concatenate(owner)
    pos = begin[:, None] + np.arange(WINDOW)
    idx = np.where(pos < (first + n)[owner][:, None], codes[np.minimum(pos, len(codes) - 1)], -1)
    return idx, owner


def score_texts(net: Net, texts) -> np.ndarray:
    """Score (0 to 1) of each text: its highest window. Texts without words
    (null and empty ones too) score 0."""
    out, k = np.zeros(len(texts)), 0
    while k < len(texts):
        size, j = 0, k
        while j < len(texts) and (j == k or size < WORDS_AT_ONCE):
            size += len(texts[j] or "") // 5
            j += 1
        uniques, codes, n = tokens(texts[k:j])
        if len(codes):
            x, _ = net.features(uniques)
            idx, owner = window_rows(codes, n)
            logit = np.concatenate([net.run(x, idx[i:i + WINDOWS_AT_ONCE]) for i in range(0, len(idx), WINDOWS_AT_ONCE)])
            best = np.full(j - k, -np.inf)
            np.maximum.at(best, owner, logit)
            out[k:j] = np.where(n > 0, sigmoid(best), 0.0)
        k = j
    return out


def fit(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Net:
    """Train on texts with labels 0/1 (in a fixed order). Without any text the
    net scores every window 0.5 at most by its zero weights."""
    rng = np.random.default_rng(seed)
    uniques, codes, n = tokens(texts)
    owner = np.repeat(np.arange(len(texts)), n)
    toxic = np.asarray(labels, bool)
    n1, n0 = int(toxic.sum()), int((~toxic).sum())

    def df(code, who, size):
        pair = np.unique(who.astype(np.int64) * size + code)
        cl, hit = pair % size, toxic[pair // size]
        return np.bincount(cl[hit], minlength=size), np.bincount(cl[~hit], minlength=size)

    d_in, f32 = 3 + WORD_DIM + CHAR_DIM, lambda *s: rng.normal(0, 0.3, s).astype(np.float32)
    p = {"word": np.zeros((1, WORD_DIM), np.float32), "gram": f32(CELLS, CHAR_DIM) * 0.3,
         "word_weight": np.zeros(1, np.float32), "gram_weight": np.zeros(CELLS, np.float32),
         "attend": f32(2 * HIDDEN), "out": f32(2 * HIDDEN), "bias": np.full(1, -1.0, np.float32)}
    for d in (0, 1):
        p |= {f"w{d}": f32(d_in, 3 * HIDDEN), f"u{d}": f32(HIDDEN, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, np.float32)}
    net = Net({}, p)
    if not len(codes):
        return net
    w1, w0 = df(codes, owner, len(uniques))
    known = np.flatnonzero(w1 + w0 >= MIN_DF_WORD)
    net.vocab = {uniques[i]: k + 1 for k, i in enumerate(known)}
    p["word"] = np.concatenate([p["word"], f32(len(known), WORD_DIM) * 0.3])
    p["word_weight"] = np.append(np.float32(0), class_weight(w1, w0, n1, n0, MIN_DF_WORD)[known])
    cells, first = gram_table(uniques)
    num = np.diff(np.append(first, len(cells)))
    pairs = np.unique(owner * len(uniques) + codes)
    who, what = pairs // len(uniques), pairs % len(uniques)
    g1, g0 = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64)
    ends = np.append(np.searchsorted(who, np.arange(len(texts))), len(who))
    seen_in = np.zeros(CELLS, bool)
    for i in range(len(texts)):
        ws = what[ends[i]:ends[i + 1]]
        size = num[ws]
        span = cells[np.repeat(first[ws] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        seen_in[span] = True
        (g1 if toxic[i] else g0)[seen_in] += 1
        seen_in[span] = False
    p["gram_weight"] = class_weight(g1, g0, n1, n0, MIN_DF_GRAM)

    idx, of = window_rows(codes, n)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items() if not k.endswith("_weight")}
    step = 0
    for epoch in range(epochs):
        x, _ = net.features(uniques)
        logit = np.concatenate([net.run(x, idx[i:i + WINDOWS_AT_ONCE]) for i in range(0, len(idx), WINDOWS_AT_ONCE)])
        if epoch == 0:
            best_word = np.maximum(x[:, 0], x[:, 1])
            logit = np.where(idx >= 0, best_word[np.maximum(idx, 0)], -1).max(1)
        order = np.lexsort((logit, of))
        last = np.flatnonzero(np.append(of[order][1:] != of[order][:-1], True))
        top = order[last]
        chosen = np.concatenate([top, order[np.maximum(last - 1, 0)][~toxic[of[order[np.maximum(last - 1, 0)]]]],
                                 rng.permutation(np.flatnonzero(~toxic[of]))[: len(top)]])
        chosen = rng.permutation(np.unique(chosen))
        for i in range(0, len(chosen), 64):
            rows = chosen[i:i + 64]
            seen, local = np.unique(idx[rows], return_inverse=True)
            local = local.reshape(len(rows), WINDOW)
            if seen[0] < 0:
                seen, local = seen[1:], local - 1
            xs, (at, cl, cnt) = net.features([uniques[s] for s in seen])
            lg, kept = net.run(xs, local, keep=True)
            y = toxic[of[rows]].astype(np.float32)
            gl = ((sigmoid(lg) - y) / len(rows)).astype(np.float32)
            g, dx = net.backward(xs, kept, gl)
            g["word"] = np.zeros_like(p["word"])
            np.add.at(g["word"], at, dx[:, 3:3 + WORD_DIM])
            g["word"][0] = 0
            g["gram"] = np.zeros_like(p["gram"])
            np.add.at(g["gram"], cl, np.repeat(dx[:, 3 + WORD_DIM:] / cnt[:, None], cnt.astype(np.int64), axis=0))
            step += 1
            for k, (m, v) in moment.items():
                if k in ("word", "gram"):
                    rows_k = np.unique(at) if k == "word" else np.unique(cl)
                else:
                    rows_k = slice(None)
                gk = g[k][rows_k]
                m[rows_k] = 0.9 * m[rows_k] + 0.1 * gk
                v[rows_k] = 0.99 * v[rows_k] + 0.01 * gk * gk
                p[k][rows_k] -= rate * (m[rows_k] / (1 - 0.9 ** step)) / (np.sqrt(v[rows_k] / (1 - 0.99 ** step)) + 1e-6)
    return net


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id",
          sample_toxic: int = SAMPLE_TOXIC, sample_clean: int = SAMPLE_CLEAN, sample_chars: int = SAMPLE_CHARS,
          **params) -> Net:
    """Fit on a sample of ``labelled`` rows with label 0 or 1: of each class
    the share that gives about the wanted number, chosen by a hash of the id
    among texts of up to ``sample_chars`` characters. Only the sample reaches
    the driver."""
    t, lab = F.col(text_col), F.col(label_col)
    rows = labelled.where(t.isNotNull() & lab.isin(0, 1) & (F.length(t) <= sample_chars))
    counts = {r[0]: r[1] for r in rows.groupBy(lab).count().collect()}
    draw = F.pmod(F.xxhash64(id_text(id_col), F.lit("toxicity sample")), F.lit(1_000_000))
    part = lambda c, want: (lab == c) & (draw < int(1_000_000 * min(1.0, want / max(1, counts.get(c, 0)))) + 1)
    got = (rows.where(part(0, sample_clean) | part(1, sample_toxic))
           .select(draw.alias("d"), id_text(id_col).alias("i"), lab.alias("y"), t.alias("t"))
           .limit(2 * (sample_toxic + sample_clean)).toPandas().sort_values(["d", "i", "y", "t"], kind="stable"))
    return fit(list(got["t"]), got["y"].to_numpy(np.int64) if len(got) else np.zeros(0, np.int64), **params)


def score(docs: DataFrame, net: Net, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a toxicity score (0 to 1) added; a column of that name is
    replaced. Null and empty texts score 0; equal texts get equal scores up to
    rounding; an empty table gives an empty result. A map over rows: no
    shuffle, and only the text enters Python."""

    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        return pd.Series(score_texts(net, list(texts)))

    tmp = free_name(docs, "toxicity")
    scored = docs.withColumn(tmp, rate(F.col(text_col)))
    return scored.select(*[c for c in docs.columns if c.lower() != out.lower()], F.col(tmp).alias(out))


def held_out_fold(id_col: str = "doc_id", folds: int = 3, fold: int = 1):
    """True for rows whose ``crc32(id as text) mod folds`` is ``fold``."""
    return F.pmod(F.crc32(id_text(id_col)), F.lit(folds)) == fold
