"""SentencePiece encoding and decoding that keeps byte offsets.

A text is normalised by the model's compiled character map: at each position the longest
key of the map that starts there is replaced, and the source position of every normalised
byte is recorded (for a model whose map is empty, for a batch of texts at once). The normalised text is cut where the model can have no piece across
(before a space mark that follows another character), each distinct segment is encoded
once with the sentencepiece library, and the pieces are projected through the recorded
alignment to spans of the original bytes.

All of it is one narrow pass over the documents: no shuffle.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_text
from tessera.llm.segments import Memo, distinct, lay_out, list_array, table

SPACE = "▁"
MARK = SPACE.encode()
MEMO = 200_000  # segments that a worker keeps
NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5  # piece types of the model file


def split_char_map(blob: bytes) -> tuple[np.ndarray, bytes]:
    """(units of the double-array trie, replacement strings, each ended by a zero byte) of a compiled map."""
    if not blob:
        return np.zeros(0, dtype="<u4"), b""
    size = struct.unpack("<I", blob[:4])[0]
    return np.frombuffer(blob[4:4 + size], dtype="<u4"), blob[4 + size:]


@dataclass
class Normalizer:
    """The model's text normalisation with source alignment."""

    char_map: bytes = b""
    dummy_prefix: bool = True
    trim: bool = False  # remove leading, trailing and repeated spaces
    escape: bool = True
    units: list[int] = field(init=False)
    strings: bytes = field(init=False)

    def __post_init__(self):
        units, self.strings = split_char_map(self.char_map)
        self.units = units.tolist()

    @property
    def is_plain(self) -> bool:
        """Nothing but a space mark for each space and before the text."""
        return not self.units and self.dummy_prefix and not self.trim and self.escape

    def longest_prefix(self, raw: bytes, at: int) -> tuple[bytes, int]:
        """(replacement, bytes of the source taken) at a position: the longest key of the map there,
        else one character as it is (a byte that is not UTF-8 becomes U+FFFD)."""
        units, node, best, size = self.units, 0, None, 0
        if units:
            unit = units[0]
            node = self._offset(unit)
            for i in range(at, len(raw)):
                node ^= raw[i]
                if node >= len(units):
                    break
                unit = units[node]
                if (unit & 0x800000FF) != raw[i]:
                    break
                node ^= self._offset(unit)
                if (unit >> 8) & 1:
                    best, size = units[node] & 0x7FFFFFFF, i + 1 - at
        if best is not None:
            return self.strings[best:self.strings.index(b"\0", best)], size
        lead = raw[at]
        n = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
        char = raw[at:at + n]
        try:
            char.decode()
        except UnicodeDecodeError:
            n = 0
        return (char, n) if n and len(char) == n else ("�".encode(), 1)

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def normalize(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, source position of every normalised byte and of the end)."""
        out, src, at = bytearray(), [], 0
        space = MARK if self.escape else b" "
        if self.trim:
            while at < len(raw):
                piece, n = self.longest_prefix(raw, at)
                if piece != b" ":
                    break
                at += n
        if at >= len(raw):
            return b"", np.zeros(1, dtype=np.int64)
        if self.dummy_prefix:
            out += space
            src += [at] * len(space)
        was_space = self.trim
        while at < len(raw):
            piece, n = self.longest_prefix(raw, at)
            while self.trim and was_space and piece.startswith(b" "):
                piece = piece[1:]
            if piece:
                new = piece.replace(b" ", space)
                out += new
                src += range(at, at + n) if new == raw[at:at + n] else [at] * len(new)
                was_space = piece.endswith(b" ")
            at += n
        end = len(raw)
        while self.trim and out.endswith(space):
            end = src[len(out) - len(space)]
            del out[-len(space):], src[len(out):]
        return bytes(out), np.array([*src, end], dtype=np.int64)

    def normalize_plain(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``normalize`` of all texts at once, if ``is_plain``: (normalised bytes in a row, end of each text in them, source
        position of each within its own text, source bytes of each text). The batch holds no null."""
        offsets = np.frombuffer(batch.buffers()[1], dtype=np.int32)[batch.offset:batch.offset + len(batch) + 1].astype(np.int64)
        data = batch.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        sizes, starts = np.diff(offsets), offsets[:-1] - offsets[0]
        src = np.arange(len(raw), dtype=np.int64) - np.repeat(starts, sizes)
        full = starts[sizes > 0]  # each of these gets the space before the text
        raw, src = np.insert(raw, full, 0x20), np.insert(src, full, 0)
        marks = raw == 0x20
        taken = np.where(marks, len(MARK), 1)
        after = np.cumsum(taken)
        norm = np.repeat(raw, taken)
        for i, b in enumerate(MARK):
            norm[after[marks] - len(MARK) + i] = b
        ends = np.concatenate([[0], after])[np.cumsum(sizes + (sizes > 0))]
        return norm, ends, np.repeat(src, taken), sizes


class PieceCodec:
    """Encoding and decoding with one model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        with open(path, "rb") as f:
            model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        spec, trainer = model.normalizer_spec, model.trainer_spec
        self.normalizer = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces,
                                     spec.escape_whitespaces)
        self.library = SentencePieceProcessor(model_file=path)
        self.kinds = np.array([p.type for p in model.pieces])
        names = [p.piece for p in model.pieces]
        crossing = any(SPACE in p.lstrip(SPACE) for p in names)
        #: Segments can be encoded one by one: BPE merges only what makes a piece, and no piece crosses a cut.
        self.by_segment = (self.normalizer.is_plain and not crossing and not trainer.treat_whitespace_as_suffix
                           and USER not in self.kinds and trainer.model_type == trainer.BPE)
        self.surface = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else p.replace(SPACE, " ").encode()
                        for p, k in zip(names, self.kinds, strict=True)]
        self.bytes, self.byte_start, self.byte_size = table(self.surface, "u1")
        #: What a piece takes of the normalised text.
        spelled = [s if k == BYTE else p.encode() for s, p, k in zip(self.surface, names, self.kinds, strict=True)]
        self.spelled, self.spelled_start, self.spelled_size = table(spelled, "u1")
        self.memo = Memo(MEMO)

    # -- encoding ---------------------------------------------------------------------------

    def encode_one(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """(ids, byte spans of the original text) of one text through the recorded alignment."""
        raw = text.encode("utf-8", "surrogatepass")
        norm, src = self.normalizer.normalize(raw)
        ids, spans, at = self.library.encode(text), [], 0
        for i in ids:
            if self.kinds[i] == UNKNOWN:  # stands for one or more characters of which no piece exists
                raise ValueError("a model without byte fallback needs the library's own spans")
            piece = self.surface[i] if self.kinds[i] == BYTE else self.library.id_to_piece(int(i)).encode()
            if norm[at:at + len(piece)] != piece:
                raise ValueError("the pieces do not spell the normalised text")
            begin, at = at, at + len(piece)
            spans.append((int(src[begin]), int(src[at])))
        return ids, spans

    def _learn(self, segments: list[str]) -> None:
        # a segment is its space marks and what follows; the library puts the first mark there itself
        for s, ids in zip(segments, self.library.encode([s[1:] for s in segments], num_threads=1), strict=True):
            self.memo[s] = np.asarray(ids if s != SPACE else [self.library.piece_to_id(SPACE)], dtype="<i4").tobytes()

    def encode(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts in a row, end of each text, source bytes of each id); null counts as empty."""
        clean = pc.fill_null(batch.cast(pa.string()), "")
        if not self.by_segment:
            every = [self.encode_one(t) for t in clean.to_pylist()]
            ids = np.array([i for x, _ in every for i in x], dtype=np.int32)
            width = np.array([b - a for _, x in every for a, b in x], dtype=np.int64)
            return ids, np.cumsum([len(x) for x, _ in every], dtype=np.int64), width
        cut = next(c for c in "\x00\x01\x02\x03\x04\x05\x06\x07\x0e\x0f"
                   if not pc.any(pc.match_substring(clean, c)).as_py())
        marked = pc.binary_join_element_wise(SPACE, pc.replace_substring(clean, " ", SPACE), "")
        marked = pc.if_else(pc.equal(clean, ""), "", marked)
        marked = pc.replace_substring_regex(marked, f"([^{SPACE}]){SPACE}", f"\\1{cut}{SPACE}")
        codes, segments, first = distinct(pc.split_pattern(marked, cut))
        segments = segments.to_pylist()
        self.memo.room(len(segments))
        self._learn([s for s in segments if s and s not in self.memo])
        self.memo[""] = b""
        flat, starts, sizes = table([self.memo[s] for s in segments], "<i4")
        ids, ends = lay_out(flat, starts, sizes, codes)
        ends = np.concatenate([[0], ends])[first[1:]]
        return ids, ends, self.byte_size[ids]

    def spans(self, batch: pa.Array, ids: np.ndarray, ends: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, end) of every id in the bytes of its own text: the pieces are laid along the normalised
        text, and where each begins and ends goes through the recorded alignment."""
        clean = pc.fill_null(batch.cast(pa.string()), "")
        starts = np.concatenate([[0], ends[:-1]])
        if not self.by_segment:
            begin, end = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            for i in range(len(ends)):
                got = self.encode_one(clean[i].as_py())[1]
                begin[starts[i]:ends[i]] = [a for a, _ in got]
                end[starts[i]:ends[i]] = [b for _, b in got]
            return begin, end
        norm, norm_ends, src, sizes = self.normalizer.normalize_plain(clean)
        spelled, at = lay_out(self.spelled, self.spelled_start, self.spelled_size, ids)
        if not (np.array_equal(np.concatenate([[0], at])[ends], norm_ends) and np.array_equal(spelled, norm)):
            raise ValueError("the pieces do not spell the normalised text")
        row = np.repeat(np.arange(len(ends)), ends - starts)
        end = np.where(at == norm_ends[row], sizes[row], np.append(src, 0)[at])
        return src[at - self.spelled_size[ids]], end

    # -- decoding ---------------------------------------------------------------------------

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of runs of ids, exactly as the library's decode()."""
        plain = np.isin(self.kinds[ids], (NORMAL, BYTE)) if len(ids) else np.zeros(0, bool)
        flat, byte_ends = lay_out(self.bytes, self.byte_start, self.byte_size, ids)
        raw, stops = flat.tobytes(), np.concatenate([[0], byte_ends])
        spec, out, start = self.normalizer, [], 0
        usual = spec.dummy_prefix and not spec.trim
        for stop in ends.tolist():
            text = None
            if start == stop:
                text = ""
            elif usual and plain[start:stop].all():
                try:
                    text = raw[stops[start]:stops[stop]].decode()
                    if self.kinds[ids[start]] == NORMAL and text.startswith(" "):
                        text = text[1:]  # the mark that encoding put before the text
                    elif self.kinds[ids[start]] == BYTE:
                        text = None
                except UnicodeDecodeError:
                    text = None
            out.append(self.library.decode(ids[start:stop].tolist()) if text is None else text)
            start = stop
        return out


_LOADED: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """One model and memo for each Python worker; later tasks of the worker go on with them."""
    if path not in _LOADED:
        _LOADED[path] = PieceCodec(path)
    return _LOADED[path]


def encode_pieces(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", spans: bool = True,
                  decoded: bool = False) -> DataFrame:
    """(id, ids array<int>[, begins array<int>, ends array<int>][, decoded string]) of every row: the
    ids without begin or end ids, the span of each in the UTF-8 bytes of the text, and the ids decoded
    again. Null and empty texts have no ids. Repeated rows are encoded one by one; other columns are ignored."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def task():
        c = codec(model_path)

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            text = b.column("text")
            ids, ends, width = c.encode(text)
            cols, names = [b.column("id"), list_array(ids, ends, pa.int32())], ["id", "ids"]
            if spans:
                a, z = c.spans(text, ids, ends, width)
                cols += [list_array(a.astype(np.int32), ends, pa.int32()), list_array(z.astype(np.int32), ends, pa.int32())]
                names += ["begins", "ends"]
            if decoded:
                cols.append(pa.array(c.decode(ids, ends), pa.string()))
                names.append("decoded")
            return pa.RecordBatch.from_arrays(cols, names)
        return one

    schema = f"id {kind}, ids array<int>" + (", begins array<int>, ends array<int>" if spans else "") + (", decoded string" if decoded else "")
    return map_text(rows, task, schema, size=4 << 20).withColumnRenamed("id", id_col)


def decode_pieces(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): every row's ids decoded. Null and empty ids give an empty text."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        c = codec(model_path)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                ids = part.column("ids")
                offsets = ids.offsets.to_numpy()
                flat = ids.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(c.decode(flat, offsets[1:] - offsets[0]), pa.string())],
                                                 ["id", "text"])

    return rows.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)
