"""Toxicity by non-negative positive-unlabelled learning.

The classifier is a numpy logistic model over binary features (words and word
beginnings). It is trained from confirmed toxic texts (P) and unlabelled texts (U)
only; no text is taken as confirmed clean. With the class prior pi the risk is

    pi * E_P[l(f, +)] + max(0, E_U[l(f, -)] - pi * E_P[l(f, -)])

whose second part estimates the risk on clean texts; when it falls below zero
(over-fitting) a step is taken that raises it again. The bias is held to pi: a text without features scores pi at most.

Bounds: about ``positives`` toxic and ``unlabelled`` unlabelled rows are used for the
fit, chosen by a hash of doc_id, and ``features`` features are kept; so the fit has a
fixed size however large the corpus. The prior is counted over all labels that may
be learned from. Scoring runs over every whole text in one narrow pass: no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import CHUNK_BYTES, cut, map_text, sample_by, texts, with_text

LETTERS = re.compile(r"[^\W\d_]+")
BEGINNINGS = (3, 4, 5, 6)
MEMO = 200_000  # tokens that a task keeps


def word_features(token: str) -> tuple[str, ...]:
    """Features of a lower-case token without white space: each run of letters in it, as a
    word (``w$``) and by its beginnings (``^w``)."""
    out: list[str] = []
    for w in LETTERS.findall(token):
        out.append(w + "$")
        out.extend("^" + w[:n] for n in BEGINNINGS if len(w) >= n)
    return tuple(out)


class Featurizer(dict):
    """token -> indices of the kept features in it (a memo of bounded size)."""

    def __init__(self, index: dict[str, int]):
        super().__init__()
        self.index = index

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= MEMO:
            self.clear()
        found = tuple(self.index[f] for f in word_features(token) if f in self.index)
        self[token] = found
        return found

    def of(self, text: str) -> list[int]:
        """Indices of all features of a whole text, each once, in order."""
        have: set[int] = set()
        for token in set(text.lower().split()):
            if hit := self[token]:
                have.update(hit)
        return sorted(have)


@dataclass
class ToxicityModel:
    features: list[str]
    weights: np.ndarray
    bias: float

    def featurizer(self) -> Featurizer:
        return Featurizer({f: i for i, f in enumerate(self.features)})

    def score(self, rows: list[list[int]]) -> np.ndarray:
        z = np.array([self.bias + float(self.weights[r].sum()) for r in rows]) if rows else np.zeros(0)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def nnpu_fit(pos: list[list[int]], unl: list[list[int]], n_features: int, prior: float, epochs: int = 400,
             rate: float = 0.05, l2: float = 5e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative PU risk (full-batch Adam)."""
    w, b = np.zeros(n_features), float(np.log(prior / (1 - prior)))

    def flat(rows):
        n = np.fromiter((len(r) for r in rows), dtype=np.int64, count=len(rows))
        idx = np.fromiter((i for r in rows for i in r), dtype=np.int64, count=int(n.sum()))
        return idx, np.repeat(np.arange(len(rows)), n), len(rows)

    P, U = flat(pos), flat(unl)

    def logits(m):
        idx, row, n = m
        return b + np.bincount(row, weights=w[idx], minlength=n)

    def back(m, g):
        idx, row, _ = m
        return np.bincount(idx, weights=g[row], minlength=n_features), g.sum()

    m1, m2 = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, epochs + 1):
        zp, zu = logits(P), logits(U)
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))  # d softplus(z)/dz
        clean_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp_pos = prior * (sp - 1) / P[2]
        gu, gp_neg = su / U[2], -prior * sp / P[2]
        if clean_risk >= 0:
            gw, gb = (x + y for x, y in zip(back(P, gp_pos + gp_neg), back(U, gu), strict=True))
        else:  # the estimate went below zero: go up on it
            gw, gb = (-(x + y) for x, y in zip(back(P, gp_neg), back(U, gu), strict=True))
        g = np.append(gw + l2 * w, gb)
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def fit_toxicity(docs: DataFrame, toxic: DataFrame, prior: float, id_col: str = "doc_id", text_col: str = "text",
                 positives: int = 3000, unlabelled: int = 6000, features: int = 1500,
                 least_docs: int = 4, purity: float = 0.7) -> ToxicityModel:
    """Fit from ``docs`` (unlabelled, all that may be learned from) and ``toxic`` (one column
    ``id_col``: the confirmed toxic ids). Null texts and ids are left out. Without a toxic
    row, or without a feature that marks one, the model scores every text 0. A feature is kept
    if by the prior at least ``purity`` of the texts that have it are toxic."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull() & F.col("id").isNotNull())
    ids = toxic.select(F.col(id_col).alias("id")).filter(F.col("id").isNotNull()).distinct()
    some = sample_by(ids.withColumn("g", F.lit(1)), "id", "g", positives).select("id")
    P = rows.join(F.broadcast(some), "id").select("text", F.lit(1).alias("y"))  # at most about `positives` ids
    U = sample_by(rows.withColumn("g", F.lit(0)), "id", "g", unlabelled).select("text", F.lit(0).alias("y"))
    sample = cut(P.unionByName(U))

    def count(candidates: dict[str, int] | None):
        def run(batches):
            sums = (Counter(), Counter())
            memo: dict[str, tuple[str, ...]] = {}
            for b in batches:
                for y, t in zip(b.column("y").to_pylist(), texts(b.column("text")), strict=True):
                    if y or candidates:
                        have: set[str] = set()
                        for w in set(t.lower().split()):
                            if (f := memo.get(w)) is None:
                                if len(memo) >= MEMO:
                                    memo.clear()
                                f = word_features(w)
                                if candidates:
                                    f = tuple(x for x in f if x in candidates)
                                memo[w] = f
                            have.update(f)
                        sums[y].update(have)
            for y, c in enumerate(sums):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.string()), pa.array([y] * len(c), pa.int32()), pa.array(list(c.values()), pa.int64())],
                    ["f", "y", "n"])
        return run

    n = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    nothing = ToxicityModel([], np.zeros(0), -50.0)
    if not n.get(1) or not n.get(0):
        return nothing
    schema = "f string, y int, n long"
    least = max(least_docs, int(0.004 * n[1]))  # bounds the candidates by features per text / 0.004
    often = (sample.filter("y = 1").mapInArrow(count(None), schema).groupBy("f").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= least).select("f").collect())
    candidates = {r.f: i for i, r in enumerate(often)}
    if not candidates:
        return nothing
    found = (sample.mapInArrow(count(candidates), schema).groupBy("f")
             .agg(F.sum(F.when(F.col("y") == 1, F.col("n"))).alias("p"), F.sum(F.when(F.col("y") == 0, F.col("n"))).alias("u"))
             .collect())  # at most the candidates

    def z(r):
        p, u = (r.p or 0) / n[1], (r.u or 0) / n[0]
        m = ((r.p or 0) + (r.u or 0)) / (n[1] + n[0])
        return (p - u) / np.sqrt(max(m * (1 - m), 1e-9) * (1 / n[1] + 1 / n[0]))

    pure = (r for r in found if prior * (r.p or 0) / n[1] >= purity * (r.u or 0) / n[0])
    ranked = sorted((-z(r), r.f) for r in pure if z(r) > 3.0)[:features]
    names = [f for _, f in ranked]
    if not names:
        return nothing
    model = ToxicityModel(names, np.zeros(len(names)), 0.0)

    def index(batches):
        memo = model.featurizer()
        for b in batches:
            have = [memo.of(t) for t in texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(have, pa.list_(pa.int32()))], ["y", "at"])

    data = sample.mapInArrow(index, "y int, at array<int>").collect()  # positives + unlabelled rows, `features` indices at most
    data = sorted((r.y, list(r["at"])) for r in data)
    model.weights, bias = nnpu_fit([a for y, a in data if y], [a for y, a in data if not y], len(names), prior)
    # however few the labels, a text without features is no likelier toxic than texts are
    model.bias = min(bias, float(np.log(prior / (1 - prior))))
    return model


def score_toxicity(df: DataFrame, model: ToxicityModel, id_cols: list[str], text_col: str = "text",
                   threshold: float = 0.3, slice_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``id_cols`` plus score double (0 to 1, higher: likelier toxic) and predicted int (1 if
    score >= threshold) for every row. A null text counts as empty and gets the score of a
    text without features. Repeated rows are judged one by one; other columns are ignored."""
    rows, names, text = with_text(df, id_cols, text_col)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def task():
        memo = model.featurizer()

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            s = model.score([memo.of(t) for t in texts(b.column(text))])
            return pa.RecordBatch.from_arrays([b.column(x) for x in names] + [pa.array(s, pa.float64())], [*names, "score"])
        return one

    out = map_text(rows, task, ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", score double", column=text, size=slice_bytes)
    return out.select(*[F.col(n).alias(c) for c, n in zip(id_cols, names, strict=True)], "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
