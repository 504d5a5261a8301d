"""Periodic runs in the word sequence of texts.

A run is a stretch of words with smallest period q, at least ``least`` words and ``repeats`` periods long, that no
neighbouring word extends. Runs are found through Lyndon words:

1. phase one of Baier's suffix sorter groups the suffixes by their longest Lyndon prefix. It takes the groups from the
   greatest to the least; every suffix i of a group w has one nearest suffix before it in a lower group, and a suffix u
   that is nearest to l of them goes into the group of ``u w^l``, just above its old one. When it is done, the context of a
   suffix's group is the longest Lyndon word that starts there: the Lyndon array, without a suffix array;
2. it runs under the order of the words and under its reverse. By the runs theorem every run holds a Lyndon word of its
   period's length that is the longest one at its place under one of the two orders (a text's end is least in both);
3. each such root (i, p) is extended by the longest common extensions of i and i + p to both sides, from ranks of all
   blocks of 2 ** k words (equal ranks if and only if equal blocks). No hashes decide.

Only stretches in which every block of ``window`` words comes up again in its text go through these steps: a run of
``max(least, repeats * q)`` words reaches back or forth by q from every block in it, so none of its blocks is alone. Block
hashes choose the stretches; a collision adds words to test, it never loses a run.

Everything is per text, so the job is one narrow pass. A task holds a slice of texts (one very long text is a slice of
its own) and 4 * log2(longest stretch) bytes for a word of the stretches.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_text, mix64
from tessera.llm.segments import distinct

LEAST, REPEATS = 24, 3


def lyndon_lengths(t: list[int]) -> list[int]:
    """Length of the longest Lyndon word at every position of ``t``, whose symbols are 0 (less than all, before
    and between texts) and 1 to some k; at a 0 it is of no use. ``t`` starts with a 0."""
    n, k = len(t), max(t)
    group = list(t)
    members: list[list[int]] = [[] for _ in range(k + 1)]
    for i, g in enumerate(t):
        members[g].append(i)
    size = [len(m) for m in members]
    length = [1] * (k + 1)
    above = [*range(1, k + 1), -1]  # order of the groups; it starts as that of the symbols
    below = [-1, *range(k)]
    left = list(range(n))  # roots are the positions of groups yet to come
    g = k
    while g:
        mine = [i for i in members[g] if group[i] == g] if len(members[g]) > size[g] else members[g]
        for i in mine:
            left[i] = i - 1
        near: dict[int, int] = {}
        for i in mine:
            p = i - 1
            while (q := left[p]) != p:  # halving
                left[p] = p = left[q]
            left[i] = p
            if t[p]:
                near[p] = near.get(p, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for p, times in near.items():
            moves.setdefault((-times, group[p]), []).append(p)
        w = length[g]
        for key in sorted(moves) if len(moves) > 1 else moves:
            ps, (times, h) = moves[key], key
            if len(ps) == size[h]:  # the whole group moves: it keeps its place
                length[h] -= times * w
                continue
            new = len(length)
            for p in ps:
                group[p] = new
            members.append(ps), size.append(len(ps)), length.append(length[h] - times * w)
            size[h] -= len(ps)
            up = above[h]
            above.append(up), below.append(h)
            above[h] = below[up] = new
        g = below[g]
    return [length[g] for g in group]


class Extensions:
    """Longest common extensions of pairs of positions in ``t`` (0 stands before, between and after the texts)."""

    def __init__(self, t: np.ndarray, longest: int):
        rank, width = t.astype(np.int32), 1
        self.ranks = [rank]
        while 2 * width <= longest and int(rank.max()) + 1 < len(rank):  # else no two blocks are equal any more
            pair = rank[:-width].astype(np.int64) * (int(rank.max()) + 1) + rank[width:]
            rank = np.unique(pair, return_inverse=True)[1].astype(np.int32)
            self.ranks.append(rank)
            width *= 2

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal symbols from i and from j on; i < j in one text."""
        done = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[k]
            a, b = i + done, j + done
            ok = b < len(rank)
            ok[ok] = rank[a[ok]] == rank[b[ok]]
            done[ok] += 1 << k
        return done

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal symbols before i and before j."""
        done = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[k]
            a, b = i - done - (1 << k), j - done - (1 << k)
            ok = a >= 0
            ok[ok] = rank[a[ok]] == rank[b[ok]]
            done[ok] += 1 << k
        return done


def runs_of(t: np.ndarray, longest: int, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """(start, length, period) of every run in ``t``, sorted; t as for ``lyndon_lengths``, ``longest`` its longest text.
    Both orders start from the ranks of the symbols, the second from their reverse."""
    if not len(t):
        return np.zeros((0, 3), dtype=np.int64)
    symbols, t = np.unique(t, return_inverse=True)  # 0 stays 0
    reach = Extensions(t, longest)
    found = []
    for order in (t, np.where(t > 0, len(symbols) - t, 0)):
        period = np.array(lyndon_lengths(order.tolist()), dtype=np.int64)
        at = np.flatnonzero((t > 0) & (period * repeats <= longest))
        p = period[at]
        start = at - reach.behind(at, at + p)
        length = at + p + reach.ahead(at, at + p) - start
        found.append(np.stack([start, length, p], axis=1)[length >= np.maximum(least, repeats * p)])
    return np.unique(np.concatenate(found), axis=0)


def window_of(least: int, repeats: int) -> int:
    """Words of a block that must come up again within a run, for every period: 2 q + window - 1 <= max(least, repeats q)."""
    return max(1, (least + 5) // 3) if repeats >= 3 else 1


def stretches(codes: np.ndarray, text: np.ndarray, first: np.ndarray, window: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the longest stretches of one text all of whose blocks come up again in it, of ``least`` words or more."""
    n = len(codes) - window + 1
    if n <= 0:
        return np.zeros((2, 0), dtype=np.int64)
    h = mix64(text[:n].astype(np.uint64) + np.uint64(1))
    for i in range(window):
        h = mix64(h ^ codes[i:i + n].astype(np.uint64))
    whole = np.arange(n) + window <= first[text[:n] + 1]  # the block does not leave its text
    order = np.argsort(h, kind="stable")
    order = order[whole[order]]
    same = h[order][1:] == h[order][:-1]
    again = np.zeros(n + 2, dtype=bool)
    again[order[1:][same] + 1] = again[order[:-1][same] + 1] = True
    start = np.flatnonzero(again[1:] & ~again[:-1])
    end = np.flatnonzero(again[:-1] & ~again[1:]) + window - 1
    # neighbouring blocks are of one text: between two texts some block leaves the first one (or window is 1)
    if window == 1 and len(start):
        cuts = first[1:-1]
        pieces = np.unique(np.concatenate([start, cuts[again[1:][np.minimum(cuts, n - 1)] & (cuts < n)]]))
        end = np.minimum(end[np.searchsorted(end, pieces, side="right")], first[text[pieces] + 1])
        start = pieces
    keep = end - start >= least
    return start[keep], end[keep]


def text_runs(codes: np.ndarray, first: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray]:
    """(text, rows of (start, length, period)) of all runs of some texts, by text, start and period. ``codes`` are the
    words (equal if and only if the words are), ``first`` the first word of every text and the end."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start, end = stretches(codes, text, first, window_of(least, repeats), least)
    if not len(start):
        return np.zeros(0, dtype=np.int64), np.zeros((0, 3), dtype=np.int64)
    sizes = end - start
    place = np.cumsum(sizes + 1) - sizes  # in the joined stretches, each with a 0 before it
    t = np.zeros(int(sizes.sum()) + len(sizes), dtype=np.int64)
    inside = np.arange(len(t)) - np.repeat(place, sizes + 1) >= 0
    t[inside] = codes[np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())] + 1
    runs = runs_of(t, int(sizes.max()), least, repeats)
    which = np.searchsorted(place, runs[:, 0], side="right") - 1
    runs[:, 0] += start[which] - place[which]
    owner = text[runs[:, 0]]
    runs[:, 0] -= first[owner]
    return owner, runs


def strongest(runs: list[list[int]]) -> list[int] | None:
    """The run of the greatest length / period, of equal ones the first, then that of the smallest period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None


WORD_BREAKS = r"[ \t-\r]+"


def split_words(column: pa.Array) -> pa.ListArray:
    """The words of every text: runs without ASCII white space, with empty strings at breaks. Null has none."""
    clean = pc.fill_null(column.cast(pa.string()), "")
    for space in "\t\n\v\f\r":
        clean = pc.replace_substring(clean, space, " ")
    return pc.split_pattern(clean, " ")


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """(id, n_words, runs, best, collapsed) for every row: all runs as (start, length, period) by start and period, the
    one with the greatest length / period (null without runs), and the text without what any run holds after its first period,
    its words joined by one space.

    A null or empty text has no words, no runs and an empty ``collapsed``. Repeated rows come out as often as they
    came in; a null id is kept. Other columns are ignored, whatever their names."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def task():
        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            codes, words, first = distinct(split_words(b.column("text")))
            blank = np.asarray(pc.equal(words, "").to_numpy(zero_copy_only=False), dtype=bool)
            if blank.any():
                full = ~blank[codes]
                first = np.concatenate([[0], np.cumsum(full)])[first]
                codes = codes[full]
            owner, found = text_runs(codes.astype(np.int64), first, least, repeats)
            drop = np.zeros(len(codes) + 1, dtype=np.int64)
            at = first[owner] + found[:, 0]
            np.add.at(drop, at + found[:, 2], 1)
            np.add.at(drop, at + found[:, 1], -1)
            kept = np.cumsum(drop)[:-1] == 0
            bounds = np.concatenate([[0], np.cumsum(kept)])[first]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words.take(pa.array(codes[kept])))
            per = np.searchsorted(owner, np.arange(len(first)))
            runs = [found[a:z].tolist() for a, z in zip(per[:-1], per[1:], strict=True)]
            best = [strongest(r) for r in runs]
            return pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.diff(first), pa.int64()), pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs], pa.list_(run)),
                 pa.array([r and dict(zip(("start", "length", "period"), r, strict=True)) for r in best], run), pc.binary_join(lists, " ")],
                ["id", "n_words", "runs", "best", "collapsed"])
        return one

    shape = "struct<start: bigint, length: bigint, period: bigint>"
    out = map_text(rows, task, f"id {kind}, n_words long, runs array<{shape}>, best {shape}, collapsed string")
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out


def run_list(runs: Column | str = "runs") -> Column:
    """All runs as text: ``start,length,period`` and a line feed for each."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def with_repeats(text: Column, draw: Column) -> Column:
    """The text with a part made periodic where ``draw`` (a number, null for never) is divisible by 10: with n words and g the
    tenth of the draw, each word i from a = g % n on becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8));
    words are then joined by one space. Without words the text stays."""
    words = F.filter(F.split(text, WORD_BREAKS), lambda w: w != "")
    g = F.floor(draw / 10)

    def edited(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        again = F.transform(F.slice(w, (a + 1).cast("int"), n), lambda _, i: F.element_at(w, (a + i % p + 1).cast("int")))
        return F.array_join(F.concat(F.slice(w, 1, a.cast("int")), again), " ")

    some = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, edited(w)).otherwise(text))[0]
    return F.when(draw % 10 == 0, some).otherwise(text)
