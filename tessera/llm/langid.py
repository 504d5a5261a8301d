"""Language ID with language-bitmask n-gram filters.

One bit-sliced Bloom filter: row i of the table is a bitmask with one bit per
language. An n-gram is added to language l by setting bit l in the k rows its
hashes name; AND-ing the k rows of an n-gram gives, in one look-up, all the
languages that contain it. A text's n-grams are looked up together and the bits
are counted per language; since a language with a fuller slice returns more
false positives, each count is corrected by that slice's false-positive rate
f: (hits - f * n) / (1 - f). The largest corrected count decides.

Fitting: documents with a language, about ``rows_per_language`` of each chosen by
a hash of doc_id (documented bound); the n-grams are counted in the tasks and the
``grams_per_language`` that occur in the most documents of a language go into its
slice, so the model has a fixed size however large the corpus. Prediction runs
over every row in one narrow pass: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_text, mix64, sample_by, texts, with_text

UNDETERMINED = "und"
SIZES = (2, 3, 4)
SLICE = 1 << 20  # texts are looked up in slices of about this many characters, to bound the arrays
_FOLD: np.ndarray | None = None


def _fold_table() -> np.ndarray:
    """Code point -> lower-case code point if it is a letter, else 32."""
    global _FOLD
    if _FOLD is None:
        table = np.full(0x110000, 32, dtype=np.uint32)
        for cp in range(0x30000):
            ch = chr(cp)
            if ch.isalpha():
                low = ch.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        _FOLD = table
    return _FOLD


def grams(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram hashes, row of each, letters per row) of all whole texts together.
    An n-gram is 2 to 4 letters, or letters with the space before or after a word;
    none spans two words."""
    joined = "\n".join([" " + t + " " for t in batch])
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter((len(t) + 3 for t in batch), dtype=np.int64, count=len(batch))
    row = np.repeat(np.arange(len(batch), dtype=np.int32), sizes)[:len(cps)]
    c = _fold_table()[cps]
    letter = c != 32
    letters = np.bincount(row[letter], minlength=len(batch))
    c64 = c.astype(np.uint64)
    out, where = [], []
    h = c64.copy()
    inner = np.ones(len(c), dtype=bool)  # no space strictly inside the n-gram
    for n in range(2, max(SIZES) + 1):
        m = len(c) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x9E3779B97F4A7C15) + c64[n - 1:]
        if n > 2:
            inner = inner[:m] & letter[n - 2:n - 2 + m]
        else:
            inner = inner[:m]
        if n in SIZES:
            ok = inner & (letter[:m] | letter[n - 1:]) if n == 2 else inner
            at = np.flatnonzero(ok)
            out.append(mix64(h[at] + np.uint64(n)))
            where.append(row[at])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), letters
    return np.concatenate(out), np.concatenate(where), letters


def slices(batch: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """(rows, texts) of about SLICE characters each; a longer text is cut at spaces, which no n-gram spans."""
    rows, some, n = [], [], 0
    for i, t in enumerate(batch):
        while t or not rows or rows[-1] != i:
            end = len(t) if len(t) <= SLICE else t.rfind(" ", 1, SLICE) + 1 or SLICE
            rows.append(i), some.append(t[:end])
            t, n = t[end:], n + end + 3
            if n >= SLICE:
                yield rows, some
                rows, some, n = [], [], 0
                if not t:
                    break
    if rows:
        yield rows, some


@dataclass
class LanguageFilter:
    """The bit-sliced filter: ``table[i]`` holds one bit per language."""

    languages: list[str]
    table: np.ndarray
    hashes: int
    rates: np.ndarray | None = None  # false-positive rate of each slice

    @classmethod
    def build(cls, per_language: list[tuple[str, np.ndarray]], bits: int = 18, hashes: int = 3) -> LanguageFilter:
        if len(per_language) > 64:
            raise ValueError("a bitmask holds 64 languages")
        width = next(t for n, t in ((8, np.uint8), (16, np.uint16), (32, np.uint32), (64, np.uint64)) if len(per_language) <= n)
        self = cls([name for name, _ in per_language], np.zeros(1 << bits, dtype=width), hashes)
        for bit, (_, g) in enumerate(per_language):
            for rows in self._rows(np.asarray(g, dtype=np.uint64)):
                self.table[rows] |= width(1 << bit)
        fill = [np.count_nonzero(self.table & width(1 << b)) / len(self.table) for b in range(len(per_language))]
        self.rates = np.array(fill) ** hashes
        return self

    def _rows(self, g: np.ndarray):
        mask = np.uint64(len(self.table) - 1)
        step = (g >> np.uint64(32)) | np.uint64(1)
        for i in range(self.hashes):
            yield (g + np.uint64(i) * step) & mask

    def masks(self, g: np.ndarray) -> np.ndarray:
        """All languages of each n-gram, as a bitmask."""
        rows = iter(self._rows(g))
        out = self.table[next(rows)]
        for more in rows:
            out &= self.table[more]
        return out

    def predict(self, batch: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, n-grams) per text."""
        n, letters = np.zeros(len(batch)), np.zeros(len(batch), dtype=np.int64)
        if not self.languages:
            return [UNDETERMINED] * len(batch), n, n.astype(np.int64)
        hits = np.zeros((len(self.languages), len(batch)))
        one = self.table.dtype.type(1)
        for rows, some in slices(batch):
            g, row, has = grams(some)
            at = np.array(rows)[row] if len(row) else row
            np.add.at(letters, rows, has)
            n += np.bincount(at, minlength=len(batch))
            found = self.masks(g)
            for b in range(len(self.languages)):
                hits[b] += np.bincount(at, weights=(found >> self.table.dtype.type(b)) & one, minlength=len(batch))
        rate = self.rates[:, None]
        counts = np.maximum(0.0, (hits - rate * n) / np.maximum(1e-9, 1.0 - rate))
        best = counts.argmax(axis=0)  # ties: the language with more fitted rows, which comes first
        top = counts[best, np.arange(len(batch))]
        rest = np.where(np.arange(len(self.languages))[:, None] == best, -1.0, counts).max(axis=0) if len(self.languages) > 1 else np.zeros(len(batch))
        share = top / np.maximum(n, 1.0)
        lead = np.where(top > 0, (top - np.maximum(rest, 0.0)) / np.maximum(top, 1e-9), 0.0)
        score = np.clip(share * (0.5 + 0.5 * lead), 0.0, 1.0)
        names = [self.languages[b] if letters[i] else UNDETERMINED for i, b in enumerate(best)]
        return names, np.where(letters > 0, score, 0.0), n.astype(np.int64)


def fit_language_filter(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                        rows_per_language: int = 2000, grams_per_language: int = 6000) -> LanguageFilter:
    """Fit from rows with a language. Null languages and texts are left out; an empty
    table gives a filter without languages (everything is then ``und``). Repeated rows
    count as often as they occur. At most about ``rows_per_language`` rows of a
    language are read, whole."""
    rows = (labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
            .filter(F.col("lang").isNotNull() & F.col("text").isNotNull()))
    sample = sample_by(rows, "id", "lang", rows_per_language).select("text", "lang")

    def count(batches):
        sums: dict[str, list[np.ndarray]] = {}
        for b in batches:
            langs = np.array(b.column("lang").to_pylist(), dtype=object)
            text = np.array(texts(b.column("text")), dtype=object)
            for lang in dict.fromkeys(langs):
                for rows, some in slices(list(text[langs == lang])):
                    g, row, _ = grams(some)
                    row = np.array(rows)[row] if len(row) else row
                    if len(g):
                        order = np.lexsort((g, row))
                        g, row = g[order], row[order]
                        first = np.ones(len(g), dtype=bool)
                        first[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
                        u, c = np.unique(g[first], return_counts=True)
                        sums.setdefault(lang, []).append(np.stack([u, c.astype(np.uint64)]))
        for lang, parts in sums.items():
            every = np.concatenate(parts, axis=1)
            u, inv = np.unique(every[0], return_inverse=True)
            c = np.bincount(inv, weights=every[1].astype(np.float64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(u), pa.string()), pa.array(u.view(np.int64)), pa.array(c)], ["lang", "gram", "n"])

    per_gram = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = per_gram.withColumn("r", rank).filter(F.col("r") <= grams_per_language).select("lang", "gram", "n").collect()
    per: dict[str, list[tuple[int, int]]] = {}
    for r in top:  # at most grams_per_language rows a language
        per.setdefault(r.lang, []).append((r.gram, r.n))
    order = sorted(per, key=lambda k: (-max(n for _, n in per[k]), k))
    return LanguageFilter.build([(k, np.array([g for g, _ in per[k]], dtype=np.int64).view(np.uint64)) for k in order])


def identify_language(df: DataFrame, model: LanguageFilter, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """``id_cols`` plus lang_pred string, score double (0 to 1), n_grams long for every row.
    Null, empty and letterless texts are ``und`` with score 0. A text none of whose
    n-grams is known goes to the first language with score 0. Repeated rows are judged
    one by one; other columns are ignored."""
    rows, names, text = with_text(df, id_cols, text_col)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def task():
        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            langs, score, n = model.predict(texts(b.column(text)))
            return pa.RecordBatch.from_arrays(
                [b.column(x) for x in names] + [pa.array(langs, pa.string()), pa.array(score), pa.array(n)],
                [*names, "lang_pred", "score", "n_grams"])
        return one

    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", lang_pred string, score double, n_grams long"
    out = map_text(rows, task, schema, column=text, size=2 * SLICE)
    return out.select(*[F.col(n).alias(c) for c, n in zip(id_cols, names, strict=True)], "lang_pred", "score", "n_grams")
