"""Language identification with string kernels.

Texts are compared by the blended-spectrum presence kernel: the number of
distinct character n-grams (lengths 1 to ``MAX_N``, lower-cased) that two texts
share, normalised by the geometric mean of their own numbers. n-grams are
hashed into ``DIM`` cells. Nyström landmarks turn the kernel into an explicit
feature map, on which one ridge regression per language (one against the rest)
is solved in closed form. Since the presence kernel is an inner product, the
landmark and regression matrices fold into one ``DIM x languages`` matrix, and a
batch of texts is scored by one product of its presence matrix with it.

So many n-grams as a long text has would set nearly all cells. Texts are read in
consecutive segments of about equal length, up to ``SEGMENT`` characters: their
kernel scores are averaged, weighted by their lengths.

The classifier is fitted on a bounded sample (``SAMPLE_PER_LANG`` segments of each
language, about that many, chosen by a hash of the id and the segment's number);
scoring reads every text whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlink.llm.common import free_name, id_text

MAX_N = 4
DIM = 1 << 16
SAMPLE_PER_LANG = 300
LANDMARKS_PER_LANG = 64
RIDGE = 1e-3
BATCH = 64
#: Characters of a segment: at most four n-grams each, so at most 15 % of the cells.
SEGMENT = 2_700
UNDETERMINED = "und"


def gram_cells(text: str, max_n: int = MAX_N) -> list[np.ndarray]:
    """Cells of all n-grams of a text, one array for each length."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out, h = [], np.zeros(len(a), np.uint32)
    for n in range(1, max_n + 1):
        if len(a) < n:
            break
        h = h[: len(a) - n + 1] * np.uint32(0x01000193) + a[n - 1:] + np.uint32(n)
        x = h * np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
        out.append((x * np.uint32(0x85EBCA77)) >> np.uint32(16))
    return out


def presence(texts, max_n: int = MAX_N) -> np.ndarray:
    """0/1 matrix (texts x DIM)."""
    m = np.zeros((len(texts), DIM), np.uint8)
    for i, t in enumerate(texts):
        for cells in gram_cells(t, max_n):
            m[i, cells] = 1
    return m


def segments(text: str, max_n: int = MAX_N) -> list[str]:
    """Consecutive parts of about equal length, up to SEGMENT characters, each
    with the ``max_n - 1`` characters that follow it: no n-gram is lost."""
    k = max(1, -(-len(text) // SEGMENT))
    cut = [len(text) * i // k for i in range(k + 1)]
    return [text[a:b + max_n - 1] for a, b in zip(cut, cut[1:])]


def has_letter(text) -> bool:
    return text is not None and any(c.isalpha() for c in text)


@dataclass
class LanguageModel:
    """``weights``: DIM x len(langs); scores are ``presence @ weights / norm``,
    averaged over a text's segments."""

    langs: list[str]
    weights: np.ndarray
    max_n: int = MAX_N

    def predict(self, texts) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of each text; ``und`` and 0 for a null
        text, one without a letter, or a model of no language."""
        pred, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        live = [i for i, t in enumerate(texts) if self.langs and has_letter(t)]
        total, length = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))

        def add(held):
            m = presence([t for _, t in held], self.max_n).astype(np.float32)
            n = np.array([len(t) for _, t in held], float)
            own = [i for i, _ in held]
            np.add.at(total, own, n[:, None] * (m @ self.weights) / np.sqrt(m.sum(1, keepdims=True)))
            np.add.at(length, own, n)

        held = []
        for i in live:
            for part in segments(texts[i], self.max_n):
                held.append((i, part))
                if len(held) == BATCH:
                    add(held)
                    held = []
        if held:
            add(held)
        for i in live:
            s = total[i] / length[i]
            best = int(np.argmax(s))
            pred[i], score[i] = self.langs[best], min(1.0, max(0.0, (float(s[best]) + 1) / 2))
        return pred, score


def fit(bits: np.ndarray, labels: list[str], landmarks_per_lang: int = LANDMARKS_PER_LANG,
        ridge: float = RIDGE, max_n: int = MAX_N) -> LanguageModel:
    """Kernel ridge regression on Nyström features. ``bits``: packed presence
    rows of the training texts, in a fixed order."""
    langs = sorted(set(labels))
    if not langs:
        return LanguageModel([], np.zeros((DIM, 0), np.float32), max_n)
    y = np.array([langs.index(x) for x in labels])
    marks = np.concatenate([np.flatnonzero(y == c)[:landmarks_per_lang] for c in range(len(langs))])
    unpack = lambda rows: np.unpackbits(rows, axis=1).astype(np.float32)
    norm = lambda m: m / np.maximum(np.sqrt(m.sum(1, keepdims=True)), 1)
    land = norm(unpack(bits[marks]))
    k_nm = np.concatenate([norm(unpack(bits[i:i + BATCH])) @ land.T for i in range(0, len(y), BATCH)]).astype(np.float64)
    vals, vecs = np.linalg.eigh((land @ land.T).astype(np.float64))
    keep = vals > 1e-6 * vals.max()
    root = vecs[:, keep] / np.sqrt(vals[keep])
    phi = k_nm @ root
    target = np.where(y[:, None] == np.arange(len(langs)), 1.0, -1.0)
    w = np.linalg.solve(phi.T @ phi + ridge * len(y) * np.eye(phi.shape[1]), phi.T @ target)
    return LanguageModel(langs, (land.T @ (root @ w)).astype(np.float32), max_n)


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          sample_per_lang: int = SAMPLE_PER_LANG, **params) -> LanguageModel:
    """Fit on a sample of ``labelled``: segments of texts with a letter and a
    non-null language. Every language keeps the share of its segments that gives
    about ``sample_per_lang`` of them. Segments are turned into presence bits
    (DIM / 8 bytes each) in the tasks that read them; only those reach the driver."""
    t, lang = F.col(text_col), F.col(lang_col)
    rows = labelled.where(t.isNotNull() & lang.isNotNull() & t.rlike(r"\p{L}"))
    many = F.ceil(F.length(t) / F.lit(SEGMENT)).cast("int")
    counts = {r[0]: r[1] for r in rows.groupBy(lang).agg(F.sum(many)).collect()}
    share = F.lit(0)
    for name, n in counts.items():
        share = F.when(lang == name, int(1_000_000 * min(1.0, sample_per_lang / n)) + 1).otherwise(share)
    draw = lambda k: F.pmod(F.xxhash64(id_text(id_col), k, F.lit("language sample")), F.lit(1_000_000))
    drawn = F.filter(F.transform(F.sequence(F.lit(0), many - 1), lambda k: F.struct(k.alias("k"), draw(k).alias("d"))),
                     lambda x: x["d"] < share)
    max_n = params.get("max_n", MAX_N)

    @F.pandas_udf("array<binary>")
    def bits(texts: pd.Series, numbers: pd.Series) -> pd.Series:
        out = []
        for x, ks in zip(texts, numbers):
            parts = segments(x, max_n)
            out.append([np.packbits(presence([parts[k]], max_n)[0]).tobytes() for k in ks])
        return pd.Series(out)

    got = rows.select(id_text(id_col).alias("i"), lang.alias("l"), t.alias("t"), drawn.alias("s")).where(F.size("s") > 0)
    got = got.select("i", "l", F.explode(F.arrays_zip(F.col("s"), bits("t", F.col("s.k")).alias("b"))).alias("e"))
    got = (got.select(F.col("e.s.d").alias("d"), "i", F.col("e.s.k").alias("k"), "l", F.col("e.b").alias("b"))
           .limit(2 * sample_per_lang * max(1, len(counts))).toPandas().sort_values(["d", "i", "k"], kind="stable"))
    packed = np.frombuffer(b"".join(map(bytes, got["b"])), np.uint8).reshape(len(got), DIM // 8)
    return fit(packed, list(got["l"]), **params)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text",
             lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with a predicted language and its score (0 to 1) added; columns
    of these names are replaced. Null texts, and texts without a letter (the
    empty one too), give ``und`` with score 0; equal texts get equal results;
    an empty table gives an empty result. Scoring is a map over rows: no
    shuffle, and only the text enters Python."""

    @F.pandas_udf("lang string, score double")
    def score(texts: pd.Series) -> pd.DataFrame:
        lang, s = model.predict(list(texts))
        return pd.DataFrame({"lang": lang, "score": s})

    tmp = free_name(docs, "identified")
    drop = [c for c in docs.columns if c.lower() in (lang_out.lower(), score_out.lower()) and c != text_col]
    out = docs.drop(*drop).withColumn(tmp, score(F.col(text_col)))
    return out.withColumn(lang_out, F.col(tmp)["lang"]).withColumn(score_out, F.col(tmp)["score"]).drop(tmp)


def held_out_fold(id_col: str = "doc_id", folds: int = 5, fold: int = 0):
    """True for rows whose ``crc32(id as text) mod folds`` is ``fold``."""
    return F.pmod(F.crc32(id_text(id_col)), F.lit(folds)) == fold


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` (all their columns) whose language is identified:
    not ``und``, with a score of at least ``min_score``."""
    p, s = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    out = identify(docs, model, text_col, p, s)
    return out.where((F.col(p) != UNDETERMINED) & (F.col(s) >= min_score)).select(*docs.columns)
