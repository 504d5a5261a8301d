"""Fill-in-middle transformation by repeated-capture matching.

One ``fullmatch`` of ``(unit)*`` with the regex library keeps every repetition of the group:
``match.ends(1)`` holds the end of each unit, so its length is n and its entries are the
offsets at which a text may be cut. No tokens are made and nothing is walked through.

Which texts are turned, how, and where they are cut depends on the id alone (32-bit words of
a SHA-256), so a retried task gives the same rows. The output can be turned back into the text by its
form alone: texts that hold a sentinel stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_text, texts

#: A longer text is matched in stretches of about so many code points, which bounds the match's memory.
STRETCH = 1 << 20


@dataclass(frozen=True)
class Infill:
    """Rules of the transformation. ``unit`` is the pattern of one token; what it matches must not depend on what follows
    the token, and every text must be a row of tokens."""

    unit: str = r"[A-Za-z]+|[^A-Za-z]"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: str = "1"
    plain_percent: int = 10
    spm_percent: int = 20


def unit_ends(units: regex.Pattern, text: str) -> np.ndarray:
    """End of every unit of the text. ValueError if the text is not a row of units."""
    found, at, width = [], 0, STRETCH
    while True:
        stop = min(len(text), at + width)
        match = units.fullmatch(text, at, stop)
        if match is None:
            raise ValueError("a text is not made of units")
        ends = np.array(match.ends(1), dtype=np.int64)
        if stop == len(text):
            found.append(ends)
            return np.concatenate(found)
        if len(ends) < 2:  # one unit of more than a stretch
            width *= 2
            continue
        found.append(ends[:-1])  # the last unit may go on
        at, width = int(ends[-2]), STRETCH


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Infill = Infill()) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) for every row. n is the number of units; form is ``psm``, ``spm``
    or ``plain``; the lengths are in code points, null for plain.

    A null text counts as empty; an empty text is plain. A null id counts as an empty one. Repeated rows come out as often as they
    came in, and rows with one id are cut by the same draw. Other columns are ignored, whatever their names."""
    draw = F.sha2(F.concat(F.lit(f"{rules.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = df.select(F.col(id_col).alias("id"), F.substring(draw, 1, 32).alias("draw"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    marks = (rules.prefix, rules.suffix, rules.middle)

    def task():
        units = regex.compile(f"(?:({rules.unit}))*+")

        def turn(draw: str, text: str) -> tuple:
            h1, h2, h3, h4 = (int(draw[i:i + 8], 16) for i in range(0, 32, 8))
            ends = unit_ends(units, text)
            n = len(ends)
            if not text or any(m in text for m in marks) or h3 % 100 >= 100 - rules.plain_percent:
                return n, "plain", None, None, text
            first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
            a, z = (int(ends[k - 1]) if k else 0 for k in (first, last))
            head, mid, tail = text[:a], text[a:z], text[z:]
            if h4 % 100 < rules.spm_percent:
                return n, "spm", a, z - a, f"{rules.suffix}{tail}{rules.prefix}{head}{rules.middle}{mid}"
            return n, "psm", a, z - a, f"{rules.prefix}{head}{rules.suffix}{tail}{rules.middle}{mid}"

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            out = [turn(d, t) for d, t in zip(b.column("draw").to_pylist(), texts(b.column("text")), strict=True)]
            n, form, a, m, text = zip(*out, strict=True) if out else ((),) * 5
            return pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(a, pa.int64()),
                                               pa.array(m, pa.int64()), pa.array(text, pa.string())], NAMES)
        return one

    out = map_text(rows, task, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out


NAMES = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]


def restored(output: Column | str = "output", form: Column | str = "form", rules: Infill = Infill()) -> Column:
    """The text an output was made from, by the output and its form alone. Null for null."""
    whole, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))

    def parts(one: str, two: str) -> tuple[Column, Column, Column]:
        """What follows the sentinels ``one``, ``two`` and the middle's, which stand in this order."""
        body = F.substring(whole, F.lit(len(one) + 1), F.length(whole))
        first = F.substring_index(body, two, 1)
        rest = F.substring(body, F.length(first) + len(two) + 1, F.length(body))
        second = F.substring_index(rest, rules.middle, 1)
        return first, second, F.substring(rest, F.length(second) + len(rules.middle) + 1, F.length(rest))

    head, tail, mid = parts(rules.prefix, rules.suffix)
    psm = F.concat(head, mid, tail)
    tail, head, mid = parts(rules.suffix, rules.prefix)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(head, mid, tail)).otherwise(whole)
