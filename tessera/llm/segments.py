"""Tokenising a batch of texts through the distinct segments in it.

A tokenizer whose result on a text is the concatenation of its results on the text's
segments needs to see each distinct segment once. Arrow splits and dictionary-encodes a
batch, only the distinct segments reach the tokenizer (those that the worker has not met
lately), and numpy lays their values out again in text order.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa


def distinct(parts: pa.ListArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of every part, the distinct parts, first part of every list and the end)."""
    offsets = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, offsets - offsets[0]


def table(values: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all values in a row, start of each, length of each) of variable-length values."""
    width = np.dtype(kind).itemsize
    ends = np.fromiter(accumulate(map(len, values)), dtype=np.int64, count=len(values)) // width
    sizes = np.diff(ends, prepend=0)
    return np.frombuffer(b"".join(values), dtype=kind), ends - sizes, sizes


def lay_out(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values of the items one after the other, end of each item)."""
    n = sizes[items]
    ends = np.cumsum(n)
    if not len(ends) or not ends[-1]:
        return flat[:0], ends
    at = np.repeat(starts[items] - (ends - n), n)
    at += np.arange(ends[-1], dtype=np.int64)
    return flat[at], ends


def list_array(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


class Memo(dict):
    """A dict that is emptied when it holds ``limit`` entries."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def room(self, more: int) -> None:
        if len(self) + more > self.limit:
            self.clear()
