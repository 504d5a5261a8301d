"""Quality by positive-unlabelled learning.

A numpy classifier is trained from trusted good texts (P) and unlabelled texts (U); no text is taken as confirmed bad.
It is additive over the shape of a text: each of ``FEATURES`` falls into one of a few bins, whose weight adds to the score.

1. The class prior pi (share of good texts in U) is estimated: a classifier of P against U orders the texts, and where only good texts are,
   U holds pi times what P holds. So pi is the least ratio U(score >= t) / P(score >= t) over thresholds that keep
   enough of P, taken at the upper end of its error.
2. The non-negative unbiased risk of the logistic loss l is minimised:
       pi * E_P[l(f, +)] + max(0, E_U[l(f, -)] - pi * E_P[l(f, -)]).
   Where the second part, the risk on bad texts, falls below zero, a step is taken that raises it.
3. The bias is set so that the mean score over U is pi.

Bounds: about ``positives`` and ``unlabelled`` rows are used for the fit, whatever the size of the corpus and however often an id or
a text comes up in it. Scoring is one narrow pass over every whole text.
"""

from __future__ import annotations

import functools
import string
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, map_text, mix64
from tessera.llm.segments import distinct

FEATURES = ("words", "word length", "upper letters", "digits", "other signs", "words without letters or digits", "words with a tail of signs",
            "short words", "long words", "distinct words", "distinct pairs", "distinct triples", "equal neighbours", "most frequent word",
            "capital words", "words ending a sentence")
#: Shares of the sample below the bin edges: both ends are divided finely.
EDGES = (0.005, 0.01, 0.02, 0.04, 0.08, 0.16, 0.32, 0.5, 0.68, 0.84, 0.92, 0.96, 0.98, 0.99, 0.995)


LETTER, UPPER, DIGIT, SIGN, STOP = 1, 2, 4, 8, 16


@functools.lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Classes of every code point: letter, upper-case letter, digit, ASCII sign, full stop or mark."""
    classes = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for i, c in enumerate(map(chr, range(sys.maxunicode + 1))):
        if c.isalpha():
            classes[i] = LETTER | UPPER * c.isupper()
        elif c.isdigit():
            classes[i] = DIGIT
    classes[[ord(c) for c in string.punctuation]] |= SIGN
    classes[[ord(c) for c in ".!?"]] |= STOP
    return classes


def word_shapes(words: pa.Array) -> np.ndarray:
    """For each word (none empty): code points, letters, upper-case letters, digits, 1 if it has no letter or digit, 1 if it ends in two signs
    or more, 1 if of several letters the first alone is upper-case and comes first, 1 if it ends in one full stop or mark."""
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(size):
        return np.zeros((0, 8))
    points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), dtype="<u4")
    kind = character_classes()[points]
    end = np.cumsum(size)
    start = end - size
    letters, upper, digits = (np.add.reduceat((kind & c > 0).astype(np.int64), start) for c in (LETTER, UPPER, DIGIT))
    last, before = kind[end - 1], np.where(size > 1, kind[end - 2], 0)
    signs = (last & SIGN > 0) & (before & SIGN > 0)
    return np.stack([size, letters, upper, digits, letters + digits == 0, signs, (letters > 1) & (upper == 1) & (kind[start] & UPPER > 0),
                     (last & STOP > 0) & (before & SIGN == 0)], axis=1).astype(np.float64)


def _distinct_share(text: np.ndarray, codes: list[np.ndarray], n_texts: int) -> np.ndarray:
    """Distinct rows of codes over all rows, for each text; 1 without rows. Rows are told apart by 64-bit hashes
    that keep each text's in one stretch."""
    h = np.zeros(len(text), dtype=np.uint64)
    for c in codes:
        h = mix64(h ^ c.astype(np.uint64))
    bits = np.uint64(max(1, int(n_texts).bit_length()))
    key = np.sort((text.astype(np.uint64) << (np.uint64(64) - bits)) | (h >> bits))
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    kinds = np.bincount((key[new] >> (np.uint64(64) - bits)).astype(np.int64), minlength=n_texts)
    rows = np.bincount(text, minlength=n_texts)
    return np.where(rows, kinds / np.maximum(rows, 1), 1.0)


def text_features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for every text; words are split at white space. Null counts as empty, whose shares are 0 (distinct shares 1)."""
    codes, words, first = distinct(pc.utf8_split_whitespace(pc.fill_null(column.cast(pa.string()), "")))
    blank = np.asarray(pc.equal(words, "").to_numpy(zero_copy_only=False), dtype=bool)
    full = ~blank[codes] if len(codes) else np.zeros(0, dtype=bool)
    first = np.concatenate([[0], np.cumsum(full)])[first]
    codes = (np.cumsum(~blank) - 1)[codes[full]].astype(np.int64)
    words = words.filter(pa.array(~blank))
    shape = word_shapes(words)
    n = len(first) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    size = np.diff(first)

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(text, weights=values, minlength=n)

    chars, letters, upper, digits, bare, tail, capital, ends = (total(shape[codes, i]) for i in range(8))
    per_word, per_char, per_letter = np.maximum(size, 1), np.maximum(chars, 1), np.maximum(letters, 1)

    def rows(k: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Text and codes of all k words in a row."""
        m = max(0, len(codes) - k + 1)
        ok = text[:m] == text[k - 1:k - 1 + m]
        return text[:m][ok], [codes[i:i + m][ok] for i in range(k)]

    pair_text, (one, two) = rows(2)
    equal = np.bincount(pair_text, weights=one == two, minlength=n)
    key = np.sort(text * max(1, len(words)) + codes)  # a text's equal words in a row
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
    most = np.zeros(n)
    np.maximum.at(most, key[at] // max(1, len(words)), np.diff(np.append(at, len(key))))
    return np.stack([
        np.log1p(size), chars / per_word, upper / per_letter, digits / per_char, (chars - letters - digits) / per_char, bare / per_word, tail / per_word,
        total(shape[codes, 0] <= 2) / per_word, total(shape[codes, 0] > 20) / per_word, _distinct_share(text, [codes], n),
        _distinct_share(*rows(2), n), _distinct_share(*rows(3), n), equal / per_word, most / per_word, capital / per_word, ends / per_word], axis=1)


@dataclass
class QualityModel:
    """Weights of the bins of every feature: ``edges`` (features x bins - 1), ``weights`` (features x bins)."""

    edges: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Place of every feature's bin among all bins."""
        width = self.weights.shape[1]
        found = [np.searchsorted(e, x[:, i], side="right") + i * width for i, e in enumerate(self.edges)]
        return np.stack(found, axis=1) if found else np.zeros((len(x), 0), dtype=np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.bias + self.weights.ravel()[self.bins(x)].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def nn_risk(w: np.ndarray, b: float, P: np.ndarray, U: np.ndarray, prior: float) -> tuple[float, float]:
    """(prior * E_P[l(f, +)], E_U[l(f, -)] - prior * E_P[l(f, -)]) with the logistic loss; rows of P and U are bin places."""
    zp, zu = b + w[P].sum(axis=1), b + w[U].sum(axis=1)
    return prior * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()


def nn_gradient(w: np.ndarray, b: float, P: np.ndarray, U: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Gradient of the step: that of both parts, or, where the second is below zero, that which raises it."""
    zp, zu = b + w[P].sum(axis=1), b + w[U].sum(axis=1)
    sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))  # l(f, -) has the slope sigmoid(f)
    bad = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    gp, gu = -prior * sp / len(P), su / len(U)
    if bad < 0:
        gp, gu = -gp, -gu
    else:
        gp = gp + prior * (sp - 1) / len(P)

    def back(rows: np.ndarray, g: np.ndarray) -> np.ndarray:
        return np.bincount(rows.ravel(), weights=np.repeat(g, rows.shape[1]), minlength=len(w))

    return back(P, gp) + back(U, gu), float(gp.sum() + gu.sum())


def adam(gradient, size: int, bias: float, steps: int, rate: float, l2: float) -> tuple[np.ndarray, float]:
    """Full-batch Adam from zero weights; ``l2`` holds the weights, not the bias."""
    x, m, v = np.append(np.zeros(size), bias), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        gw, gb = gradient(x[:-1], x[-1])
        g = np.append(gw + l2 * x[:-1], gb)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return x[:-1], float(x[-1])


def estimate_prior(p: np.ndarray, u: np.ndarray, least: float = 0.2) -> float:
    """Share of P's class in U by the scores of P and U: the least upper bound of U(score >= t) / P(score >= t) over
    thresholds that keep a share of at least ``least`` of P."""
    best = 1.0
    for share in np.linspace(least, 1.0, 33):
        t = np.quantile(p, 1 - share)
        a, c = (u >= t).mean(), (p >= t).mean()
        best = min(best, (a + np.sqrt(a * (1 - a) / len(u)) + 1 / len(u)) / c)
    return float(np.clip(best, 0.01, 0.99))


def fit(x_p: np.ndarray, x_u: np.ndarray, steps: int = 300, rate: float = 0.05, hold: float = 5.0) -> QualityModel:
    """The model from the features of P and U (rows of either may be few; without any the score is 0.5 everywhere). ``hold`` is the
    strength of the weights' prior in rows of P: few rows move them little."""
    l2 = hold / max(1, len(x_p))
    k = len(FEATURES)
    if not len(x_p) or not len(x_u):
        return QualityModel(np.zeros((k, 0)), np.zeros((k, 1)), 0.0, 0.5)
    model = QualityModel(np.quantile(x_u, EDGES, axis=0).T, np.zeros((k, len(EDGES) + 1)), 0.0, 0.5)
    P, U, size = model.bins(x_p), model.bins(x_u), model.weights.size

    def apart(w, b):  # P against U, both with half of the weight
        gp, gu = (-0.5 / (1 + np.exp(b + w[P].sum(axis=1))) / len(P), 0.5 / (1 + np.exp(-(b + w[U].sum(axis=1)))) / len(U))
        g = np.bincount(P.ravel(), np.repeat(gp, k), size) + np.bincount(U.ravel(), np.repeat(gu, k), size)
        return g, gp.sum() + gu.sum()

    w, b = adam(apart, size, 0.0, steps // 2, rate, l2)
    model.prior = prior = estimate_prior(b + w[P].sum(axis=1), b + w[U].sum(axis=1))
    w, b = adam(lambda w, b: nn_gradient(w, b, P, U, prior), size, float(np.log(prior / (1 - prior))), steps, rate, l2)
    z = w[U].sum(axis=1)
    low, high = -50.0, 50.0
    for _ in range(60):  # the bias at which the mean score over U is the prior
        b = (low + high) / 2
        low, high = (b, high) if (1 / (1 + np.exp(-np.clip(z + b, -50, 50)))).mean() < prior else (low, b)
    model.weights, model.bias = w.reshape(model.weights.shape), b
    return model


def fit_quality(docs: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text", positives: int = 5000,
                unlabelled: int = 10000) -> QualityModel:
    """Fit from ``docs`` (unlabelled, all that may be learned from) and ``good`` (one column ``id_col``: ids of trusted good texts). Null texts
    and ids are left out. About ``positives`` ids and rows, and ``unlabelled`` rows, are taken, each row by its own draw, so that
    repeated ids and texts do not enlarge the sample."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull() & F.col("id").isNotNull())
    ids = good.select(F.col(id_col).alias("id")).filter(F.col("id").isNotNull()).distinct()

    def some(df: DataFrame, bound: int, draw) -> DataFrame:
        n = df.count()
        return df.filter(draw < min(1.0, bound / max(1, n)))

    spot = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    chosen = F.broadcast(some(ids, positives, spot))  # about `positives` ids
    P = some(rows.join(chosen, "id", "left_semi"), positives, F.rand(11)).select("text", F.lit(1).alias("y"))
    U = some(rows, unlabelled, F.rand(12)).select("text", F.lit(0).alias("y"))
    sample = cut(P.unionByName(U))

    def task():
        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            x = text_features(b.column("text"))
            return pa.RecordBatch.from_arrays([b.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])
        return one

    data = sorted((r.y, r.x) for r in map_text(sample, task, "y int, x array<double>").collect())  # a few numbers a sampled row
    x = [np.array([v for y, v in data if y == k], dtype=np.float64).reshape(-1, len(FEATURES)) for k in (1, 0)]
    return fit(*x)


def score_quality(df: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(id, score, predicted) for every row: score 0 to 1, higher for good texts; predicted int, 1 if score >= threshold. A null text
    counts as empty and is scored by its shape like any other. Repeated rows are judged one by one, a null id is
    kept; other columns are ignored, whatever their names."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def task():
        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            s = model.score(text_features(b.column("text")))
            return pa.RecordBatch.from_arrays([b.column("id"), pa.array(s, pa.float64())], ["id", "score"])
        return one

    out = map_text(rows, task, f"id {kind}, score double")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
