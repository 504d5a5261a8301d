"""Exact top-k search by inner product with a three-phase uniform threshold.

The score of a query and a candidate is the sum over ``lists`` blocks of dimensions; each
block is one score list. Partial scores are shifted by the list's least value for the
query, so that all are >= 0, and:

1. every (query block, candidate block) cell gives its best k entries of each list and the
   list's least value; the k entries best over all cells are scored in full, and the k-th
   best of those full scores is a lower bound tau of the k-th best score;
2. with tau' = tau minus the least values, whatever scores tau or more has at least tau' / lists
   in some list; that cutoff goes back to the cells, which give all entries at or above it;
3. entries whose upper bound (the known lists, and the cutoff for the others) reaches tau
   are scored in full, exactly, and ranked.

Equal vectors are one candidate class with the smallest k + 1 ids (ties go to the smaller id,
and a query leaves out only itself), and equal query vectors are one query, so a vector
that a third of the rows share is scored once.

Queries and candidates meet block by block; a cell is one task's row of bounded size
(``block`` vectors on either side), and only scores leave it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut

SLICE = 256  # queries scored at a time against a block
EXACT = 1 << 53  # below it float64 holds every integer, so BLAS gives exact sums


def scaled(vector: str | Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as long; null for a vector that is null or holds a null or
    non-finite component."""
    v = F.col(vector) if isinstance(vector, str) else vector
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(v.isNotNull() & ok, F.transform(v, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column, width: int) -> np.ndarray:
    """Rows of lists of long; shorter vectors are filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.values.slice(column.offsets[0].as_py(), int(sizes.sum())).to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    bound = (int(np.abs(q).max(initial=0)) + 1) * (int(np.abs(c).max(initial=0)) + 1) * max(1, q.shape[1])
    if bound < EXACT:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    if bound >= 1 << 63:
        raise OverflowError("an inner product may not fit a long")
    return q @ c.T


def _blocks(rows: DataFrame, name: str, size: int) -> tuple[int, DataFrame]:
    """(block, arrays of key and vector): rows dealt to blocks of about ``size`` by a hash of the key; the number of blocks."""
    n = max(1, -(-rows.count() // size))
    return n, (rows.withColumn("b", F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")).groupBy("b")
            .agg(F.collect_list(F.struct("key", "v")).alias(name)).withColumnRenamed("b", f"{name}_block"))


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "v", k: int = 10, lists: int = 2,
          block: int = 4096) -> DataFrame:
    """(query_id, rank, id, score): for every row that ``is_query`` marks its k candidates of the highest
    inner product (all, if there are fewer), ties to the smaller id; a row is no candidate of
    its own id. ``vec_col`` holds integers (see ``scaled``); rows with a null id or vector take no part.
    Repeated (id, vector) rows count once. Vectors of different sizes meet as if filled with zeros."""
    rows = (vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<bigint>").alias("v"), is_query.alias("q"))
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull()))
    kind = rows.schema["id"].dataType.simpleString()
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    # classes of equal vectors with their k + 1 smallest distinct ids: Spark keeps k + 1 a vector before the exchange
    small = (rows.select("v", "id").distinct().withColumn("n", first).filter(F.col("n") <= k + 1).groupBy("v")
             .agg(F.sort_array(F.collect_list("id")).alias("ids"), F.min("id").alias("key")))
    classes = cut(small.select("key", "v", "ids"))
    asked = rows.filter("q").select("id", "v").distinct()
    queries = cut(asked.groupBy("v").agg(F.min("id").alias("key")).select("key", "v"))
    members = asked.join(queries.withColumnRenamed("key", "query"), "v").select("query", F.col("id").alias("query_id"))
    width = classes.agg(F.max(F.size("v"))).first()[0] or 0
    if not width:
        width = 1
    lists = min(lists, width)
    edges = [round(i * width / lists) for i in range(lists + 1)]
    need = k + 1  # a query's own class may be among the best

    _, cblocks = _blocks(classes.select("key", "v"), "c", block)
    many, qblocks = _blocks(queries, "qs", block)
    # every candidate block meets every query block: the stated queries against all rows, in blocks
    cells = cblocks.withColumn("qs_block", F.explode(F.sequence(F.lit(0), F.lit(many - 1)))).join(qblocks, "qs_block")

    def each(batches):
        for b in batches:
            for i in range(b.num_rows):
                q, c = b.column("qs")[i].values, b.column("c")[i].values
                qv, cv = _matrix(q.field("v"), width), _matrix(c.field("v"), width)
                for at in range(0, len(qv), SLICE):
                    some = qv[at:at + SLICE]
                    parts = [_products(some[:, a:z], cv[:, a:z]) for a, z in zip(edges, edges[1:], strict=False)]
                    yield b, i, q.field("key").slice(at, SLICE), c.field("key"), parts

    def frame(b, qkeys, ckeys, qi, ci, list_no, score):
        return pa.RecordBatch.from_arrays(
            [qkeys.take(pa.array(qi)), ckeys.take(pa.array(ci)), pa.array(list_no.astype(np.int32)), pa.array(score)],
            ["query", "key", "list", "score"])

    def gather(batches):
        for b, _, qkeys, ckeys, parts in each(batches):
            for no, s in enumerate(parts):
                take = min(need, s.shape[1])
                top = np.argpartition(-s, take - 1, axis=1)[:, :take]
                low = s.argmin(axis=1)[:, None]  # the list's least value goes along as list -1 - no
                qi = np.repeat(np.arange(len(s)), take)
                yield frame(b, qkeys, ckeys, qi, top.ravel(), np.full(top.size, no), np.take_along_axis(s, top, 1).ravel())
                yield frame(b, qkeys, ckeys, np.arange(len(s)), low.ravel(), np.full(len(s), -1 - no),
                            np.take_along_axis(s, low, 1).ravel())

    schema = f"query {kind}, key {kind}, list int, score long"
    local = cut(cells.mapInArrow(gather, schema))
    least = local.filter("list < 0").groupBy("query", "list").agg(F.min("score").alias("least"))
    least = least.groupBy("query").agg(F.sum("least").alias("least_sum"),
                                       F.map_from_entries(F.collect_list(F.struct((-1 - F.col("list")).alias("list"), "least"))).alias("least"))
    best = F.row_number().over(Window.partitionBy("query", "list").orderBy(F.desc("score"), "key"))
    leads = local.filter("list >= 0").withColumn("n", best).filter(F.col("n") <= need).select("query", "key").distinct()

    vq = queries.select(F.col("key").alias("query"), F.col("v").alias("qv"))
    vc = classes.select("key", "v")

    def resolve(pairs: DataFrame) -> DataFrame:
        """(query, key, score) with the full inner product."""
        zero = F.lit(0).cast("bigint")
        product = F.aggregate(F.zip_with("qv", "v", lambda a, b: F.coalesce(a, zero) * F.coalesce(b, zero)), zero, lambda a, x: a + x)
        return pairs.join(vq, "query").join(vc, "key").select("query", "key", product.alias("score"))

    kth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))
    tau = (resolve(leads).withColumn("n", kth).filter(F.col("n") <= need).groupBy("query")
           .agg(F.min("score").alias("tau"), F.count(F.lit(1)).alias("n")))
    # fewer than k + 1 leads (few candidates): nothing may be left out
    bound = tau.join(least, "query").select(
        "query", "tau", "least", "least_sum", (F.col("n") >= need).alias("full"),
        F.ceil((F.col("tau") - F.col("least_sum")) / F.lit(float(lists))).alias("cutoff"))
    # the cutoff of a query's list as a partial score, not shifted; rounding is to the safe side
    cuts = cut(bound.select("query", "tau", F.when(F.col("full"), F.transform(
        F.sequence(F.lit(0), F.lit(lists - 1)), lambda i: F.col("cutoff") - 1 + F.element_at("least", i))).alias("cuts")))
    qcuts = (queries.join(cuts, queries["key"] == cuts["query"]).withColumn(
        "b", F.pmod(F.xxhash64("key"), F.lit(many)).cast("int"))
        .groupBy("b").agg(F.collect_list(F.struct("key", "cuts", "tau")).alias("cuts")).withColumnRenamed("b", "qs_block"))

    def collect(batches):
        told_of, told = None, {}
        for b, i, qkeys, ckeys, parts in each(batches):
            if told_of != (id(b), i):
                told_of, told = (id(b), i), {r["key"]: (r["cuts"], r["tau"]) for r in b.column("cuts")[i].as_py()}
            lines = [told.get(x, (None, None)) for x in qkeys.to_pylist()]
            seen = np.zeros(parts[0].shape, dtype=bool)
            upper = np.zeros(parts[0].shape, dtype=np.int64)
            for no, s in enumerate(parts):
                line = np.array([np.iinfo(np.int64).min if x is None else x[no] for x, _ in lines])[:, None]
                seen |= s >= line
                upper += np.where(s >= line, s, line)
            goal = np.array([np.iinfo(np.int64).min if x is None else t for x, t in lines])[:, None]
            qi, ci = np.nonzero(seen & ((upper >= goal) | (goal == np.iinfo(np.int64).min)))
            yield frame(b, qkeys, ckeys, qi, ci, np.zeros(len(qi)), upper[qi, ci])

    enough = cells.join(qcuts, "qs_block").mapInArrow(collect, schema).select("query", "key")
    scored = resolve(enough).withColumn("n", kth).filter(F.col("n") <= need)
    # classes back to ids, then each query's own id out
    order = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    ids = (scored.join(classes.select("key", "ids"), "key").select("query", "score", F.explode("ids").alias("id"))
           .withColumn("n", order).filter(F.col("n") <= need))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (members.join(ids, "query").filter(F.col("id") != F.col("query_id")).withColumn("rank", rank)
            .filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))
