"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

A piece of s tokens goes into the open bin (or a new one) for which the sum over all
residual gaps of (number of open bins with that gap) squared becomes smallest; ties
go to the smaller gap. Pieces are taken longest first, so the many short ones fill the last gaps.

Distribution: tokenising is one narrow pass that yields a small row per piece (no
tokens are shuffled); it is written once to the checkpoint folder. The pieces are
then dealt by a hash of all they hold and of their place to shards of about ``shard_rows`` and
each shard is packed by itself, in bounded memory. A shard leaves a few open bins, so
its cost against one global packing is a few sequences in ``shard_rows`` pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, map_text
from tessera.llm.segments import Memo, distinct, lay_out, table

MEMO = 250_000  # words that a worker keeps
MARKS = ".,!?;:*#%$&|"  # none starts a contraction
# Latin letters whose lower case is one code point and that are their own composed form, then marks
PLAIN = ("^(?P<word>[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)"
         "(?P<rest>[.,!?;:*#%$&|]*)$")
SHARD_STEP = 1 << 32


class WordIds:
    """Token ids of whole texts.

    The tokenizer drops white space before it merges anything, so a text's ids are those of
    its space-separated parts in order. A part made of plain Latin letters and marks after
    them is that word in lower case, then the marks (``plain``: this tokenizer cuts there);
    unknown words are encoded many at a time, each ending with an end-of-word token. Any
    other part is encoded by itself."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.memo = Memo(MEMO)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        probes = ["thand", "für", "éeaux", "ñasco", "xqzvw"]
        self.plain = all(self.ends[x[-1]] and not self.ends[x[:-1]].any() for x in map(self._ids, probes)) and all(
            np.array_equal(self._ids(w.title() + m), np.append(self._ids(w), self._ids(m)))
            for w in probes for m in (*MARKS, ".***", "!!"))

    def _ids(self, part: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(part, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, words: list[str]) -> None:
        for some in (words[i:i + 512] for i in range(0, len(words), 512)):
            ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            raw, start = ids.tobytes(), 0
            for w, end in zip(some, ends, strict=True):
                self.memo[w] = raw[4 * start:4 * end]
                start = end

    def encode(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, end of each text); null counts as empty."""
        clean = pc.replace_substring(pc.fill_null(batch.cast(pa.string()), ""), "\n", " ")
        codes, parts, first = distinct(pc.split_pattern(clean, " "))
        cut = pc.extract_regex(parts, pattern=PLAIN if self.plain else "(?P<word>^$)(?P<rest>)")
        is_plain = cut.is_valid()
        word = pc.if_else(is_plain, pc.utf8_lower(pc.struct_field(cut, "word")), "").dictionary_encode()
        rest = pc.if_else(is_plain, pc.struct_field(cut, "rest"), parts).dictionary_encode()
        words, rests = word.dictionary.to_pylist(), rest.dictionary.to_pylist()
        memo = self.memo
        memo.room(len(words) + len(rests))
        self._learn([w for w in words if w and w not in memo])
        for p in rests:
            if p not in memo:
                memo[p] = self._ids(p).tobytes()
        if "" not in memo:
            memo[""] = b""
        flat, starts, sizes = table([memo[w] for w in words] + [memo[p] for p in rests], "<u4")
        at = np.stack([word.indices.to_numpy(), rest.indices.to_numpy().astype(np.int64) + len(words)], axis=1)
        ids, ends = lay_out(flat, starts, sizes, at[codes].ravel())
        return ids, np.concatenate([[0], ends])[2 * first[1:]]


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One tokenizer and memo for each Python worker; later tasks of the worker go on with them."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def tokenize_pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = 2048,
                    end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document: its ids, then ``end_id``, cut
    into pieces of ``size``; the last piece may be shorter. A null text is empty (one piece: the end id)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def task():
        memo = word_ids(tokenizer_path)

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            at, piece, start, length, crc, ids = [], [], [], [], [], []
            every, ends = memo.encode(b.column("text"))
            begin = 0
            for i, stop in enumerate(ends.tolist()):
                raw = every[begin:stop].tobytes() + end
                begin = stop
                for k, a in enumerate(range(0, len(raw), 4 * size)):
                    part = raw[a:a + 4 * size]
                    at.append(i), piece.append(k), start.append(a // 4), length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            cols = [b.column("id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(cols, names)
        return one

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return map_text(rows, task, schema).withColumnRenamed("id", id_col)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each item, taken in the given order, and the number of bins."""
    count = np.zeros(size + 1, dtype=np.int64)  # open bins per gap; a full bin is closed
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]
    bins, offsets, made = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        # change of the sum when gap g becomes g - s, for g = s .. size - 1; a gap of 0 no longer counts
        after = 2 * count[:size - s] + 1
        if len(after):
            after[0] = 0
        change = after - 2 * count[s:size] + 1
        change[count[s:size] == 0] = np.iinfo(np.int64).max
        fresh = 2 * int(count[size - s]) + 1 if s < size else 0
        g = int(change.argmin()) if len(change) else -1
        if g >= 0 and change[g] <= fresh:
            gap = g + s
            b = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, b = size, made
            made += 1
        bins[i], offsets[i] = b, size - gap
        left = gap - s
        if left:
            open_bins[left].append(b)
            count[left] += 1
    return bins, offsets, made


def pack_pieces(pieces: DataFrame, id_col: str = "doc_id", size: int = 2048, shard_rows: int = 40_000) -> DataFrame:
    """The pieces with sequence_id long and offset long. Sequences hold at most ``size`` tokens,
    without gaps from offset 0. Every row is placed, repeated rows too, whatever their ids (null among them); an empty table
    stays empty. Rows are dealt to shards of about ``shard_rows`` by all they hold and their place in the materialised table, so that
    copies of one row do not fill one shard; each shard is packed by itself."""
    pieces = cut(pieces)
    shards = max(1, -(-pieces.count() // shard_rows))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards)))
    kind = pieces.schema[id_col].dataType.simpleString()
    names = [id_col, "piece", "start", "length", "ids_crc32"]

    def place(rows: pa.Table) -> pa.Table:
        order = [("length", "descending"), *((c, "ascending") for c in (id_col, "piece", "start", "ids_crc32"))]
        rows = rows.combine_chunks().sort_by(order)
        bins, offsets, _ = sum_of_squares(rows.column("length").to_numpy(), size)
        first = rows.column("shard")[0].as_py() * SHARD_STEP
        return rows.select(names).append_column("sequence_id", pa.array(first + bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return dealt.select(*names, "shard").groupBy("shard").applyInArrow(place, schema)
