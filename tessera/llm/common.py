"""Helpers shared by the llm operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, shuffles_freed  # noqa: F401 (also for the operators)

MASK64 = (1 << 64) - 1
#: A Python stage cuts what Arrow hands it into pieces of about this many bytes of text.
CHUNK_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 4 is 2 (a null id is never held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def cut(df: DataFrame) -> DataFrame:
    """Lineage cut in the shared checkpoint folder (survives a lost executor)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again, in slices of about ``size`` bytes of text (one long text is one slice)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        start = 0
        while start < n:
            stop = int(np.searchsorted(ends, ends[start] + size, side="right")) - 1
            stop = min(n, max(stop, start + 1))
            yield batch.slice(start, stop - start)
            start = stop


def map_text(df: DataFrame, fn: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str,
             column: str = "text", size: int = CHUNK_BYTES) -> DataFrame:
    """``mapInArrow`` over slices of bounded size. ``fn`` makes the per-slice function
    once a task, so that models are loaded and memos kept per task."""
    def run(batches):
        one = fn()
        for piece in text_chunks(batches, column, size):
            yield one(piece)
        del one
        give_back()
    return df.mapInArrow(run, schema)


def with_text(df: DataFrame, id_cols: list[str], text_col: str) -> tuple[DataFrame, list[str], str]:
    """(the id columns and the text under names of their own, the names of the id columns, the name of the text).
    A text that is one of the id columns goes to the workers once."""
    names = [f"_id{i}" for i in range(len(id_cols))]
    ids = [F.col(c).alias(n) for c, n in zip(id_cols, names, strict=True)]
    if text_col in id_cols:
        return df.select(*ids), names, names[id_cols.index(text_col)]
    return df.select(*ids, F.col(text_col).alias("text")), names, "text"


def give_back() -> None:
    """Return a worker's free memory to the system: Spark keeps workers, and the next task may need other sizes."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def texts(column: pa.Array) -> list[str]:
    """Python strings, null as empty."""
    return [t or "" for t in column.to_pylist()]


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), vectorised."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def sample_by(df: DataFrame, key: str, group: str, bound: int) -> DataFrame:
    """About ``bound`` rows of each ``group`` at most, chosen by a hash of ``key``:
    a first pass counts the groups, the second keeps the share of each that fits.
    The choice depends on the row alone, so a retried task keeps the same rows."""
    counts = {r[0]: r[1] for r in df.groupBy(group).count().collect()}
    if not counts:
        return df
    share = F.lit(1.0)
    for value, n in counts.items():
        if n > bound:
            share = F.when(F.col(group) == F.lit(value), F.lit(bound / n)).otherwise(share)
    spot = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30)).cast("double") / float(1 << 30)
    return df.filter(spot < share)
