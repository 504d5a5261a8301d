"""N-gram Jaccard join by token-combination prefixes, down to connected components.

A document's set holds its distinct n-word shingles as 64-bit hashes; equal sets are one
node, named by a 64-bit hash (n distinct sets share a name with a chance of n * n / 2 ** 65). Two nodes link when 100 * intersection >= percent * union.

Tokens (shingles) are ordered rare first, then the frequent ones by rising count. A set of n
tokens needs an overlap of at least a = ceil(percent * n / 100), so two linked sets share
their first k common tokens within their first n - a + k tokens. With k = 2, for sets of up
to ``LONG`` tokens and some more: either the first common token is rare, and is indexed by
itself, or the first two are frequent, and the pair is indexed: a common passage alone then
brings no two documents together. For longer sets k = 1, so that the keys of a set stay
linear in its size. Sets near the bound carry both kinds of keys, so that no linked pair is lost.

A token is frequent if it occurs in about ``FREQUENT`` of all documents: at most
mean set size / FREQUENT * 2 tokens, whatever the corpus size. Which tokens count as
frequent changes the work, never the result.

Candidates are not expanded into all pairs of a large group of a key:

1. in a group of up to ``SMALL`` members each meets those before it that pass the size and
   positional filters; in a larger one each member meets the pivot, the member with the fewest
   rarer tokens before the key. Parity bits of the sets rule out pairs that differ in too many
   bits. Of what is left the likeliest pair of every node is verified, which gives components;
2. of the others those whose components still differ are verified; pairs within a component need no test;
3. in large groups of several components each node meets those of other components. The groups of
   pairs with one first token are joined, where that makes fewer pairs, so that nodes with many pairs in
   common come up once a token. Short parities, 1024, 512 or 256 bits, are part of this last join, so
   that it makes few pairs that cannot link.

The filters only leave out what cannot link.

Verification is exact on the whole sets, which are made again from the texts of
candidate documents only; a bitmap of fixed size tells which documents may be candidates.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, give_back, map_text, mix64, shuffles_freed, text_chunks
from tessera.llm.segments import distinct
from tessera.session import scratch_path

LONG = 400
FREQUENT = 0.002
BLOCK = 500_000  # shingles counted at a time in a task
SLICE = 2 << 20  # bytes of text that a task turns into sets at a time
SEEN = 1_000_000  # set names a task keeps
SMALL = 64  # members of a group that meet one another
BITS = 1 << 26  # of the candidate bitmap: 8 MB at any corpus size
_A = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, first word of every text and the end). Words are runs without
    ASCII white space, A-Z lower-cased; null counts as empty."""
    clean = pc.ascii_lower(pc.fill_null(batch.cast(pa.string()), ""))
    for space in "\t\n\v\f\r":
        clean = pc.replace_substring(clean, space, " ")
    codes, words, first = distinct(pc.split_pattern(clean, " "))
    words = words.to_pylist()
    table = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    if "" in words:  # between two white spaces, or at either end of a text
        full = codes != words.index("")
        first = np.concatenate([[0], np.cumsum(full)])[first]
        codes = codes[full]
    return table[codes] if len(codes) else np.zeros(0, np.uint64), first


def shingle_sets(batch: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct shingles of every text, as sorted hashes; the whole text is one if it has fewer words."""
    w, first = word_hashes(batch)
    h = w.copy()
    m = max(0, len(w) - size + 1)
    h = h[:m]
    for i in range(1, size):
        h = h * _A + w[i:i + m]
    h = mix64(h + np.uint64(size))
    out = []
    for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if z - a >= size:
            s = np.sort(h[a:z - size + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif z > a:
            x = w[a:a + 1].copy()
            for v in w[a + 1:z]:
                x = x * _A + v
            out.append(mix64(x + np.uint64(z - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(s: np.ndarray) -> int | None:
    """64-bit id of a set (signed), None for the empty set."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None


class FrequentTokens:
    """The frequent tokens with their place in the order (rising count)."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens = tokens[order]
        self.rank = np.lexsort((self.tokens, counts[order])).argsort()

    def split(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rare, frequent) tokens of a set, each in the global order."""
        if not len(self.tokens):
            return s, s[:0]
        at = np.minimum(np.searchsorted(self.tokens, s), len(self.tokens) - 1)
        hit = self.tokens[at] == s
        often = s[hit]
        return s[~hit], often[np.argsort(self.rank[at[hit]], kind="stable")]


def index_keys(s: np.ndarray, frequent: FrequentTokens, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, position of each key's first token) of a set."""
    return keys_and_heads(s, frequent, percent)[:2]


def keys_and_heads(s: np.ndarray, frequent: FrequentTokens, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """(keys, position of each key's first token, the token at every position) of a set; None for the tokens if
    every key is its first token."""
    n = len(s)
    if 100 * n < percent * (n + 1):  # one token more is too many: only an equal set can link
        return s[:0], np.zeros(0, np.int32), None
    need = -(-percent * n // 100)
    rare, often = frequent.split(s)
    single, double = 100 * n >= percent * LONG, percent * n <= 100 * LONG
    p = n - need + 1
    long = min(n, p + 1)
    r = min(len(rare), long if double else p)
    keys, at = [rare[:r]], [np.arange(r)]
    if single and p > len(rare):
        m = p - len(rare)
        keys.append(often[:m]), at.append(len(rare) + np.arange(m))
    if double and long > len(rare) + 1:
        f = often[:long - len(rare)]
        i, j = np.triu_indices(len(f), 1)
        keys.append(mix64(f[i] * _A + f[j])), at.append(len(rare) + i)
    heads = np.concatenate([rare, often])[:long] if double else None
    return np.concatenate(keys), np.concatenate(at).astype(np.int32), heads


def frequent_tokens(docs: DataFrame, size: int) -> FrequentTokens:
    """Tokens in about FREQUENT of all documents. A task gives those frequent among its own documents;
    what is frequent over all is frequent in some task."""
    def run(batches):
        buffer, n, n_docs = np.empty(BLOCK, dtype=np.uint64), 0, 0

        def flush():
            held = buffer[:n]
            held.sort()
            starts = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if n else np.zeros(0, np.int64)
            c = np.diff(np.append(starts, n))
            often = c >= max(3, FREQUENT * n_docs)
            yield pa.RecordBatch.from_arrays([pa.array(held[starts[often]].view(np.int64)), pa.array(c[often].astype(np.int64))], ["token", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([n_docs], pa.int64())], ["token", "n"])

        for b in text_chunks(batches, size=SLICE):
            for s in shingle_sets(b.column("text"), size):
                if n and n + len(s) > BLOCK:
                    yield from flush()
                    n, n_docs = 0, 0
                n_docs += 1
                if len(s) > BLOCK:  # one very long text; its tokens are distinct, each counts once
                    buffer = s.copy()
                    n = len(s)
                    yield from flush()
                    buffer, n, n_docs = np.empty(BLOCK, dtype=np.uint64), 0, 0
                    continue
                buffer[n:n + len(s)] = s
                n += len(s)
        if n_docs:
            yield from flush()
        del buffer
        give_back()

    sums = cut(docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))
    total = sums.filter("token IS NULL").agg(F.sum("n")).first()[0] or 0
    least = max(3, int(total * FREQUENT / 2))
    rows = sums.filter(F.col("token").isNotNull() & (F.col("n") >= least)).collect()  # at most mean set size * 2 / FREQUENT
    return FrequentTokens(np.array([r.token for r in rows], dtype=np.int64).view(np.uint64), np.array([r.n for r in rows], dtype=np.int64))


def connected(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node of the edges (a, b), by large-star and
    small-star rounds; each round is cut in the checkpoint folder and shuffles its edges three times."""
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    of_node = Window.partitionBy("u")
    state = None
    while True:
        sign = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == state or not sign[0]:
            return e.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("comp"))
        state = sign
        both = _pairs_of(e, ("u", "v"), ("v", "u"))
        large = both.withColumn("m", F.least(F.min("v").over(of_node), "u")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(_pairs_of(large.withColumn("m", F.min("v").over(of_node)), ("u", "m"), ("v", "m")).filter("u <> v").distinct())


def _pairs_of(rows: DataFrame, *columns: tuple[str, str]) -> DataFrame:
    """(u, v): for every row one for each of the given pairs of columns."""
    made = F.explode(F.array(*[F.struct(F.col(x).alias("u"), F.col(y).alias("v")) for x, y in columns]))
    return rows.select(made.alias("pair")).select("pair.u", "pair.v")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85) -> DataFrame:
    """(id, n_shingles, component_id) for every row: the size of its set, and the smallest id reachable by
    links, its own included. Null and empty texts have an empty set and link with nothing, not even
    each other. Rows with a null id take part and have the smallest id of their component, null
    if it has none. Repeated rows come out as often as they came in."""
    whole = _components(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), size, percent)
    least = whole.filter(F.col("comp").isNotNull()).groupBy("comp").agg(F.min("id").alias("least"))
    return whole.join(least, "comp", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))


def text_mark(text: str = "text") -> Column:
    """MD5 of a text; null for null."""
    return F.unhex(F.md5(F.col(text)))


def jaccard_representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85) -> DataFrame:
    """(id, mark) of one row a component of ``jaccard_components``, the one with the smallest id (null last) and then the
    smallest ``text_mark``, and of every distinct row with an empty set."""
    whole = _components(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), text_mark(text_col).alias("mark")), size, percent)
    row = F.struct(F.col("id").isNull().alias("no_id"), "id", "mark")
    return (whole.groupBy("comp", F.when(F.col("comp").isNull(), row).alias("alone")).agg(F.min(row).alias("r"))
            .select(F.col("r.id").alias(id_col), "r.mark"))


def _components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, n, comp) for every row of docs (id, text), with the mark if docs has one: comp is the smallest name of a set
    reachable by links, null for an empty set."""
    marked = [c for c in docs.columns if c == "mark"]
    with shuffles_freed(docs.sparkSession):
        nodes, comp = _linked(docs, size, percent)
    return nodes.join(comp, "node", "left").select("id", "n", F.coalesce("comp", "node").alias("comp"), *marked)


def _linked(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows (id, n, node), with the mark if docs has one, and the components (node, comp) of the nodes that have links."""
    spark = docs.sparkSession
    marked = [c for c in docs.columns if c == "mark"]
    kind = docs.schema["id"].dataType.simpleString()
    frequent = frequent_tokens(docs, size)

    def index():
        seen: set[int] = set()

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            n, node, keys, at, heads, bits = [], [], [], [], [], []
            for s in shingle_sets(b.column("text"), size):
                d = digest(s)
                n.append(len(s)), node.append(d)
                if d is None or d in seen:  # equal sets have equal keys: once a task is enough
                    keys.append(None), at.append(None), heads.append(None), bits.append(None)
                else:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(d)
                    k, p, h = keys_and_heads(s, frequent, percent)
                    keys.append(k.view(np.int64)), at.append(p), bits.append(parity(s))
                    heads.append(None if h is None else h.view(np.int64))
            return pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(at, pa.list_(pa.int32())), pa.array(heads, pa.list_(pa.int64())), pa.array(bits, pa.binary()),
                 *[b.column(c) for c in marked]],
                ["id", "n", "node", "keys", "at", "heads", "bits", *marked])
        return one

    path = scratch_path(spark, f"ngram-{uuid.uuid4().hex[:12]}")
    map_text(docs, index, f"id {kind}, n long, node long, keys array<long>, at array<int>, heads array<long>, bits binary" + ", mark binary" * len(marked), size=SLICE).write.parquet(f"{path}/index")
    stored = spark.read.parquet(f"{path}/index")
    nodes = stored.select("id", "n", "node", *marked)

    def may_link(n1, at1, n2, at2):
        fits = F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent
        return fits & (F.least(n1 - at1, n2 - at2) * (100 + percent) >= (n1 + n2) * percent)

    # 1. in a small group every member meets those before it, in a large one the pivot
    # a row carries its size and position as one number: most rows are alone under their key, and all are shuffled
    mark = F.shiftleft(F.col("n"), 32) + F.col("k.at").cast("long")

    def n_of(m):
        return F.shiftright(m, 32)

    def at_of(m):
        return m.bitwiseAND(F.lit((1 << 32) - 1))

    rows = stored.select("node", F.explode(F.arrays_zip("keys", "at")).alias("k"), "n").select(
        F.col("k.keys").alias("key"), "node", mark.alias("m"))
    by_mark = Window.partitionBy("key").orderBy("m", "node")
    rows = rows.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("key")))
    other = F.when(F.col("size") <= SMALL, F.struct("node", "m"))  # large groups gather nothing
    rows = rows.withColumn("before", F.collect_list(other).over(by_mark.rowsBetween(-SMALL, -1))).filter("size > 1")
    meets = F.filter("before", lambda o: (o["node"] != F.col("node")) & may_link(n_of(F.col("m")), at_of(F.col("m")), n_of(o["m"]), at_of(o["m"])))
    rows = rows.select("key", "node", n_of(F.col("m")).alias("n"), at_of(F.col("m")).alias("at"), (F.col("size") > SMALL).alias("large"),
                       F.when(F.col("size") <= SMALL, F.transform(meets, lambda o: o["node"])).alias("meets"))
    rows.filter("large or size(meets) > 0").write.parquet(f"{path}/groups")
    rows = spark.read.parquet(f"{path}/groups")

    def ordered(x, y):
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    col = F.col
    large = rows.filter("large").select("key", "node", "n", "at")
    pivot = F.first(F.struct("node", "n", "at")).over(Window.partitionBy("key").orderBy("at", "n", "node"))
    pairs = (rows.select("node", F.explode("meets").alias("o")).select(*ordered("node", "o"))
             .unionByName(large.withColumn("p", pivot).filter((col("node") != col("p.node")) & may_link(
                 col("n"), col("at"), col("p.n"), col("p.at"))).select(*ordered("node", "p.node"))).distinct())
    marks = stored.filter(F.col("bits").isNotNull()).groupBy("node").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    pairs = cut(_may_overlap(pairs, marks, percent))
    # first each node's likeliest pair; what that joins need not be tested again
    sides = pairs.select(F.col("a").alias("x"), "far", F.col("b").alias("y")).unionByName(
        pairs.select(F.col("b").alias("x"), "far", F.col("a").alias("y")))
    likely = sides.groupBy("x").agg(F.min(F.struct("far", "y"))["y"].alias("y")).select(*ordered("x", "y")).distinct()
    likely = cut(likely)
    tested = _Tests(docs, nodes, size, percent, f"{path}/sets")
    comp = connected(tested.links(likely))

    # 2. the pairs found so far that the components still leave apart
    of_a, of_b = (comp.select(F.col("node").alias(x), F.col("comp").alias(f"comp_{x}")) for x in "ab")
    rest = cut(pairs.select("a", "b").join(of_a, "a", "left").join(of_b, "b", "left")
               .filter(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select("a", "b"))
    if not rest.isEmpty():
        comp = _merged(comp, tested.links(rest))

    # 3. in large groups of several components all nodes that are still apart
    named = _gathered(large, stored, comp)
    apart = named.groupBy("group", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("group").agg(
        F.max(F.struct("c", "comp"))["comp"].alias("main"), F.count(F.lit(1)).alias("comps")).filter("comps > 1").select("group", "main")
    open_rows = cut(named.join(apart, "group"))
    if open_rows.isEmpty():
        return nodes, comp
    open_rows = open_rows.join(_short_marks(marks, open_rows.select("node").distinct()), "node")
    # of two nodes in different components of a group at least one is outside the largest
    x = open_rows.filter("comp <> main").select("group", *[col(c).alias(f"x_{c}") for c in OPEN])
    y = open_rows.select("group", "main", *[col(c).alias(f"y_{c}") for c in OPEN])
    more = (x.join(y, "group").filter((col("x_comp") != col("y_comp")) & ((col("y_comp") == col("main")) | (col("x_node") < col("y_node")))
                                      & may_link(col("x_n"), col("x_at"), col("y_n"), col("y_at")) & _short_may_overlap(percent))
            .select(*ordered("x_node", "y_node")).distinct())
    more = _may_overlap(more, marks, percent).select("a", "b").join(likely.unionByName(rest), ["a", "b"], "left_anti")
    more = cut(more)
    if not more.isEmpty():
        comp = _merged(comp, tested.links(more))

    return nodes, comp


def _merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, comp) after further links (a, b): what was joined before is one edge a node."""
    if links.isEmpty():
        return comp
    return connected(comp.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(links))


def _gathered(large: DataFrame, stored: DataFrame, comp: DataFrame) -> DataFrame:
    """(group, node, n, at, comp): the rows by which the nodes of large groups (key, node, n, at) meet. The pair keys of a set
    that start with one token are one group, named by that token, unless their own groups hold fewer pairs. Two linked
    nodes have the same first token in the first key that they share, at the positions which that key has."""
    large = cut(large.distinct())
    spots = cut(large.groupBy("node", "at").agg(F.first("n").alias("n"), F.min("key").alias("key")))
    heads = (stored.filter(F.col("bits").isNotNull()).select("node", "heads").join(spots.select("node").distinct(), "node", "left_semi")
             .groupBy("node").agg(F.first("heads").alias("heads")))
    spots = spots.join(heads, "node").select("node", "n", "at", F.coalesce(F.get("heads", F.col("at").cast("int")), "key").alias("token"))
    spots = cut(spots.join(comp, "node", "left").select("token", "node", "n", "at", F.coalesce("comp", "node").alias("comp")))
    keys = large.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("node", "at")).alias("one"))
    keys = cut(keys.select("key", "size", "one.node", "one.at").join(spots.select("node", "at", "token"), ["node", "at"]).select("key", "size", "token"))
    wide = (spots.groupBy("token").agg(F.count(F.lit(1)).alias("size"))
            .join(keys.groupBy("token").agg(F.sum(F.col("size") * F.col("size")).alias("meets")), "token")
            .filter("size * size > meets").select("token"))
    by_key = large.join(keys.join(wide, "token").select("key"), "key").join(comp, "node", "left").select(
        F.col("key").alias("group"), "node", "n", "at", F.coalesce("comp", "node").alias("comp"))
    return cut(spots.join(wide, "token", "left_anti").withColumnRenamed("token", "group").unionByName(by_key))


OPEN = ("node", "n", "at", "comp", "short", "shorter", "shortest")  # what a node brings to its large groups


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A parity folded to ``size`` bytes, which leaves it a parity."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def _short_marks(marks: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, short, shorter, shortest): the parity bits of the wanted nodes as 16, 8 (null for small sets) and 4 LONGs."""
    def run(batches):
        for b in batches:
            bits = [np.frombuffer(x.as_buffer(), dtype=np.uint8) for x in b.column("bits")]
            short = [pa.array([folded(x, size).view("<i8") if len(x) >= size else None for x in bits], pa.list_(pa.int64())) for size in (128, 64, 32)]
            yield pa.RecordBatch.from_arrays([b.column("node"), *short], ["node", "short", "shorter", "shortest"])

    return marks.join(wanted, "node", "left_semi").select("node", "bits").mapInArrow(run, "node long, short array<long>, shorter array<long>, shortest array<long>")


def _short_may_overlap(percent: int) -> Column:
    """As ``_may_overlap``, by the short parities, so that most pairs of a large group that cannot link are never made."""
    def far(c: str) -> Column:
        apart = F.zip_with(f"x_{c}", f"y_{c}", lambda p, q: F.bit_count(p.bitwiseXOR(q)))
        return F.aggregate(apart, F.lit(0), lambda s, k: s + k)

    total = F.col("x_n") + F.col("y_n")
    return (total - F.coalesce(far("short"), far("shorter"), far("shortest"))) * (100 + percent) >= total * (2 * percent)


class _Tests:
    """Exact tests of pairs of nodes; the sets that earlier tests made from the texts are kept."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, size: int, percent: int, path: str):
        self.docs, self.nodes, self.size, self.percent, self.path = docs, nodes, size, percent, path
        self.sets: DataFrame | None = None
        self.have: DataFrame | None = None
        self.rounds = 0

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs that link."""
        wanted = _ends(pairs)
        if self.have is not None:
            wanted = wanted.join(self.have, "node", "left_anti")
        wanted = cut(wanted)
        self.rounds += 1
        _write_sets(self.docs, self.nodes, wanted, self.size, f"{self.path}/{self.rounds}")
        made = self.docs.sparkSession.read.schema("node long, tokens binary").parquet(f"{self.path}/{self.rounds}")
        self.sets = made if self.sets is None else self.sets.unionByName(made)
        self.have = wanted if self.have is None else self.have.unionByName(wanted)
        return cut(_verify(self.sets, pairs, self.percent))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def parity(s: np.ndarray) -> bytes:
    """For each of 256 to 131,072 bits, at least twice the set's size, whether an odd number of tokens falls on it."""
    size = min(1 << 17, max(256, 1 << (2 * len(s) - 1).bit_length()))
    odd = np.bincount((s % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def bits_apart(x: np.ndarray, y: np.ndarray) -> int:
    """Bits in which two parities differ; the longer one is folded to the shorter, which leaves it a parity."""
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _may_overlap(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """(a, b, far) of the pairs that may link by their parity bits: every bit in which two sets differ takes
    a token that only one of them has, so with ``far`` such bits they share (n1 + n2 - far) / 2 at most."""
    def test(batches):
        for b in batches:
            far = np.array([bits_apart(np.frombuffer(x.as_buffer(), dtype=np.uint8), np.frombuffer(y.as_buffer(), dtype=np.uint8))
                            for x, y in zip(b.column("bits_a"), b.column("bits_b"), strict=True)], dtype=np.int64)
            total = b.column("n_a").to_numpy() + b.column("n_b").to_numpy()
            keep = (total - far) * (100 + percent) >= 2 * percent * total
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(far)], ["a", "b", "far"]).filter(pa.array(keep))

    x, y = (marks.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("bits").alias(f"bits_{k}")) for k in "ab")
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return both.mapInArrow(test, "a long, b long, far long")


def _write_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, size: int, path: str) -> None:
    """Writes (node, tokens) of the wanted nodes."""
    # a document of every wanted node; the ids of these set bits in a bitmap of fixed size
    owners = nodes.join(wanted, "node").groupBy("node").agg(F.min("id").alias("id"))
    spot = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(BITS))
    maps = (owners.select(F.floor(spot / 32768).alias("bucket"), (spot % 32768).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("m")).collect())  # BITS / 8 bytes at most
    bitmap = np.zeros(BITS // 8, dtype=np.uint8)
    for r in maps:
        bitmap[r.bucket * 4096:(r.bucket + 1) * 4096] = np.frombuffer(bytes(r.m), dtype=np.uint8)

    def task():
        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            at = b.column("spot").to_numpy()
            b = b.filter(pa.array((bitmap[at >> 3] >> (at & 7) & 1).astype(bool)))
            sets = shingle_sets(b.column("text"), size)
            return pa.RecordBatch.from_arrays(
                [pa.array([digest(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["node", "tokens"])
        return one

    sets = map_text(docs.select(spot.alias("spot"), "text"), task, "node long, tokens binary", size=SLICE)
    sets.join(wanted, "node", "left_semi").dropDuplicates(["node"]).write.parquet(path)


def _verify(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets link."""
    def test(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                s, t = np.frombuffer(x.as_buffer(), dtype="<u8"), np.frombuffer(y.as_buffer(), dtype="<u8")
                common = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * common >= percent * (len(s) + len(t) - common))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(test, "a long, b long")
