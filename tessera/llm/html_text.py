"""Main text of web pages.

The pages of a host decide by a suffix array: the token streams of all their blocks, those inside
``article`` or ``main`` and the others, are laid end to end, suffixes are ranked by prefix doubling, substrings
of at least ``REPEAT`` tokens that occur on two distinct pages of the host are marked, and the runs
that stay unique are proposed as the text. Menus, footers, sidebars, notices, adverts, forms,
scripts and comments are known by their markup and are in no stream.

A check by markup follows for every page that has an ``article`` or ``main`` element: marked runs inside are
given back, since a host has copies of articles and passages that its articles share, and proposed
runs outside are left out (see the README for what the array alone gets wrong). For the same
reason what a page shows outside counts as marked only if another page shows it outside too.

Parsing is one narrow pass. The streams are shuffled once, by host; a host
with more than ``HOST_PAGES`` pages is dealt to several suffix arrays of about that size, its shares.
What repeats between shares outside articles is found by the 128-bit hashes of all runs of ``REPEAT`` tokens: each
share gives its distinct ones, and those of two shares go back to the shares that have them. Inside, the
check gives back what any share has marked. So the text does not depend on how a host is dealt.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import MASK64, map_text, mix64, texts
from tessera.llm.urls import url_host

REPEAT = 8
HOST_PAGES = 512

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|iframe|select)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
ATTR = re.compile(r"""(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
SPACE = re.compile(r"\s+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var".split())
MAIN = frozenset(("article", "main"))
OUT = frozenset("nav footer aside form button menu dialog head".split())
OUT_WORDS = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies footer "
                      "menu modal nav navbar navigation newsletter notice notices pagination popup promo related share sharing "
                      "sidebar social sponsor sponsored subscribe complementary contentinfo search alert".split())


def _is_out(tag: str, attrs: str, inside_main: bool) -> bool:
    if tag in OUT or (tag == "header" and not inside_main):
        return True
    if not attrs or tag in MAIN or tag in ("html", "body"):
        return False
    return any(w in OUT_WORDS for m in ATTR.finditer(attrs) for w in re.split(r"[^a-z]+", m[2].lower()) if w)


def blocks(page: str) -> tuple[bool, list[str], list[str]]:
    """(has an article, blocks inside it, other blocks outside menus and the like), with character references decoded
    and each run of white space one space; empty blocks are left out."""
    main: list[str] = []
    rest: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # open block elements: tag, is out, is main
    some: list[str] = []
    has_main, n_out, n_main, at = False, 0, 0, 0

    def close():
        if some:
            text = SPACE.sub(" ", html.unescape("".join(some))).strip()
            some.clear()
            if text and not n_out:
                (main if n_main else rest).append(text)

    for m in TOKEN.finditer(page):
        if m.start() > at:
            some.append(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"]:
                some.append(" ")
            continue
        tag = tag.lower()
        if tag in INLINE:
            continue
        if tag in VOID:
            if tag in ("br", "wbr"):
                some.append(" " if tag == "br" else "")
            else:
                close()
            continue
        close()
        if m["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    for _, o, is_main in stack[i:]:
                        n_out, n_main = n_out - o, n_main - is_main
                    del stack[i:]
                    break
        else:
            if tag in MAIN and n_out and not n_main:  # a menu that was never closed ends here
                stack.clear()
                n_out = 0
            if tag == "p" and stack and stack[-1][0] == "p":
                _, o, is_main = stack.pop()
                n_out, n_main = n_out - o, n_main - is_main
            o, is_main = _is_out(tag, m["attrs"], n_main > 0), tag in MAIN
            if m["attrs"].rstrip().endswith("/"):
                continue
            has_main |= is_main
            stack.append((tag, o, is_main))
            n_out, n_main = n_out + o, n_main + is_main
    if at < len(page):
        some.append(page[at:])
    close()
    return has_main, main, rest


def repeated(streams: list[list[str]], least: int = REPEAT, page: np.ndarray | None = None, inside: np.ndarray | None = None) -> list[np.ndarray]:
    """For every stream's tokens: which are covered by a substring of at least ``least`` tokens that
    occurs on another page too, for streams that are not ``inside`` an article: outside on another page. Every stream is
    a page of its own unless ``page`` numbers them. Suffixes are ranked by prefix doubling: after the step to length h
    two suffixes have one rank if and only if their first h tokens are equal."""
    sizes = np.array([len(s) for s in streams], dtype=np.int64)
    n = int(sizes.sum()) + len(sizes)
    ends = np.cumsum(sizes + 1)
    names: dict[str, int] = defaultdict(lambda: len(names))
    tokens = np.empty(n, dtype=np.int64)
    word = np.ones(n, dtype=bool)
    word[ends - 1] = False
    tokens[word] = np.fromiter(map(names.__getitem__, chain.from_iterable(streams)), dtype=np.int64, count=n - len(sizes))
    tokens[~word] = -1 - np.arange(len(sizes))  # no substring goes past the end of its stream
    stream = np.repeat(np.arange(len(sizes)), sizes + 1)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    h = 1
    while h < least:
        step = min(h, least - h)
        after = np.zeros(n, dtype=np.int64)
        if n > step:
            after[:n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        h += step
    order = np.argsort(rank, kind="stable")
    first = np.flatnonzero(np.diff(rank[order], prepend=-1))  # of each group of equal ranks
    p = stream if page is None else np.asarray(page)[stream]
    many = (np.minimum.reduceat(p[order], first) < np.maximum.reduceat(p[order], first))[rank]
    if inside is not None:
        out = ~np.asarray(inside, dtype=bool)[stream]
        low = np.minimum.reduceat(np.where(out, p, n)[order], first)
        high = np.maximum.reduceat(np.where(out, p, -1)[order], first)
        many = np.where(out, (low < high)[rank], many)
    begin = np.flatnonzero(many)
    begin = begin[stream[np.minimum(begin + least - 1, n - 1)] == stream[begin]]
    hit = np.zeros(n + 1, dtype=np.int64)
    hit[begin] += 1
    hit[np.minimum(begin + least, n)] -= 1
    covered = np.cumsum(hit[:n]) > 0
    return [covered[e - s - 1:e - 1] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]


def run_hashes(streams: list[list[str]], least: int = REPEAT) -> tuple[np.ndarray, np.ndarray]:
    """(128-bit hash of every run of ``least`` tokens within a page as a row of two words, its place in the pages laid
    end to end). Equal runs have equal hashes in every task."""
    names: dict[str, int] = {}
    sizes = np.array([len(s) for s in streams], dtype=np.int64)
    codes = np.fromiter((names.setdefault(t, len(names)) for s in streams for t in s), dtype=np.int64, count=int(sizes.sum()))
    digests = [xxhash.xxh3_128_intdigest(t) for t in names]
    words = np.array([(d >> 64, d & MASK64) for d in digests], dtype=np.uint64).reshape(-1, 2)[codes]
    n = max(0, len(words) - least + 1)
    h = mix64(words[:n])
    for i in range(1, least):
        h = mix64(h + words[i:i + n])
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(words))  # tokens up to the end of the page
    at = np.flatnonzero(left[:n] >= least)
    return h[at], at


def _numbers(h: np.ndarray) -> np.ndarray:
    """A number for every row, the same for equal rows only."""
    order = np.lexsort((h[:, 1], h[:, 0]))
    s = h[order]
    out = np.zeros(len(h), dtype=np.int64)
    out[order[1:]] = np.cumsum((s[1:] != s[:-1]).any(axis=1))
    return out


def main_texts(rest: list[list[str]], main: list[list[str] | None], least: int = REPEAT, shared: np.ndarray | None = None) -> list[str]:
    """The text of pages of one host by their blocks outside an article and inside, None without one. Proposed are each block's
    tokens that no repeated substring covers, nor outside a run whose hash is among ``shared``; the check
    by markup keeps all of an article, and nothing else of a page that has one."""
    n = len(rest)
    split = [[b.split(" ") for b in bs or ()] for bs in (*rest, *main)]
    streams = [list(chain.from_iterable(bs)) for bs in split]
    cover = repeated(streams, least, np.tile(np.arange(n), 2), np.arange(2 * n) >= n)
    if shared is not None and len(shared):
        h, at = run_hashes(streams[:n], least)
        number = _numbers(np.concatenate([shared, h]))
        begin = at[np.isin(number[len(shared):], number[:len(shared)])]
        ends = np.cumsum([len(s) for s in streams[:n]])
        hit = np.zeros(ends[-1] + 1, dtype=np.int64)
        hit[begin] += 1
        hit[begin + least] -= 1
        cover[:n] = [c | (x > 0) for c, x in zip(cover[:n], np.split(np.cumsum(hit[:-1]), ends[:-1]), strict=True)]
    out = []
    for i in range(n):
        kept = []
        for blocks_, bs, gone, inside in ((rest[i], split[i], cover[i], False), (main[i] or (), split[n + i], cover[n + i], True)):
            keep = (~gone | inside) & (inside or main[i] is None)
            at = 0
            for whole, b in zip(blocks_, bs, strict=True):
                k = keep[at:at + len(b)]
                at += len(b)
                if k.all():
                    kept.append(whole)
                elif k.any():
                    kept.append(" ".join(t for t, x in zip(b, k.tolist(), strict=True) if x))
        out.append("\n".join(kept))
    return out


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for every row: the blocks of the main text joined by line breaks. Null and empty
    html, and pages without text, give an empty text. Null urls are one host. Repeated rows
    come out as often as they came in; copies are one page to the suffix array only if their id and url are equal."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), url_host(F.col(url_col)).alias("host"), F.col(html_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    # hosts of several shares: at most one for every HOST_PAGES pages
    large = rows.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / HOST_PAGES).cast("int").alias("shares")).filter("shares > 1")
    # pandas knows no LONG with a null: ids go through it as text
    rows = rows.join(F.broadcast(large), "host", "left").select(
        F.col("id").cast("string").alias("id"), "url", F.md5(F.coalesce("text", F.lit(""))).alias("mark"), "host", F.coalesce("shares", F.lit(1)).alias("shares"), "text")
    share = F.pmod(F.xxhash64("id", "url", "mark"), F.col("shares")).alias("share")
    rows = rows.select("id", "url", "mark", "host", "shares", share, "text")

    def parse():
        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [blocks(t) for t in texts(b.column("text"))]
            return pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(["\n".join(f[2]) for f in found], pa.string()),
                 pa.array(["\n".join(f[1]) if f[0] else None for f in found], pa.string())],
                [*b.schema.names[:-1], "rest", "main"])
        return one

    # blocks hold no line break: joined by one they are one value
    dealt = map_text(rows, parse, "id string, url string, mark string, host string, shares int, share long, rest string, main string", size=4 << 20)

    def pages_of(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, list[list[str]]]:
        pdf = pdf.sort_values(["id", "url", "mark"], ignore_index=True)
        same = pdf.duplicated(["id", "url", "mark"]).to_numpy()
        return pdf, same, [r.split("\n") if r and not s else [] for r, s in zip(pdf["rest"], same, strict=True)]

    def runs(key, pdf: pd.DataFrame) -> pd.DataFrame:
        several = pdf["shares"].iloc[0] > 1
        h, _ = run_hashes([[t for b in bs for t in b.split(" ")] for bs in pages_of(pdf)[2]] if several else [])
        h = h[np.unique(_numbers(h), return_index=True)[1]].view(np.int64)
        return pd.DataFrame({"host": key[0], "share": key[1], "high": h[:, 0], "low": h[:, 1]})

    def run(key, pdf: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        pdf, same, rest = pages_of(pdf)
        main = [None if m is None else m.split("\n") if m and not s else [] for m, s in zip(pdf["main"], same, strict=True)]
        text = main_texts(rest, main, shared=shared[["high", "low"]].to_numpy(dtype=np.int64).view(np.uint64))
        for i in np.flatnonzero(same):
            text[i] = text[i - 1]
        return pdf[["id", "url"]].assign(text=text)

    # the runs of tokens outside articles that two shares of a host have: a share gives each of its runs once
    given = dealt.groupBy("host", "share").applyInPandas(runs, "host string, share long, high long, low long")
    of_run = Window.partitionBy("host", "high", "low")
    shared = (given.withColumns({"first": F.min("share").over(of_run), "last": F.max("share").over(of_run)})
              .filter("first < last").select("host", "share", "high", "low"))
    by_host = dealt.groupBy("host", "share").cogroup(shared.groupBy("host", "share")).applyInPandas(run, "id string, url string, text string")
    return by_host.select(F.col("id").cast(kind).alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
