"""Offset-preserving SentencePiece encoding and decoding (BPE models).

1. *Normalisation.* The longest prefix that the model's compiled character map
   knows is replaced by what it maps to, any other character stays; white space is
   escaped and a mark put in front, as the model says. Beside every normalised
   character stands the byte offset of the source it came from. A model without a
   map (an identity normaliser) gives the same by arithmetic on whole arrays.
2. *Segmentation.* Neighbouring symbols are merged, best score first, leftmost on
   ties. No piece crosses from another character to the space mark, and
   characters of no longer piece never merge, so the text falls into units that are
   encoded once per worker and kept in a table of bounded size; new units of one
   length are merged side by side as arrays, long ones with a heap. Characters
   without a piece become byte pieces.
3. *Projection.* The characters that every piece covers, counted on, are looked up
   in the offsets: every piece's span of original bytes. Of the byte pieces of one
   character the last has its span, the others an empty one before it.
4. *Decoding* joins what the pieces stand for.

Defined cases: null text counts as empty (begin and end ids only, or none); special pieces written in a text are
plain text; a text of one unit without spaces is one heap of its length; repeated rows
are encoded each; other columns are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, prepare, vocabulary_file, whole_text

MARK = "▁"  # stands for a space inside pieces
KEPT_UNITS = 600_000        # of a worker's table; it starts anew beyond
LONG_UNIT = 40              # characters; longer units are merged one by one
GATHERED_CHARS = 4_000_000  # of texts whose new units are merged together
NORMAL, CONTROL, USER, BYTE = 1, 3, 4, 6  # piece types of the model file
_RIGHT = 1 << 22  # symbols are below: piece ids, then characters without a piece
_NONE = np.iinfo(np.int64).max


def _message(blob: bytes):
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = blob[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(blob):
        key = varint()
        size = {1: 8, 5: 4}.get(key & 7)
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = varint() if size is None else size
            at += size
            yield key >> 3, blob[at - size:at]


class CharacterMap:
    """The compiled character map: a double-array trie over bytes and the strings its values point to."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.strings = blob[4 + size:]

    def longest(self, data: bytes, at: int):
        """(replacement, bytes consumed) of the longest known prefix of data[at:]; None if there is none."""
        step = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)
        if not self.units:
            return None
        node, found = step(self.units[0]), None
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= step(unit)
            if unit >> 8 & 1:
                found = (self.units[node] & 0x7FFFFFFF, k + 1 - at)
        if found is None:
            return None
        begin = found[0]
        return self.strings[begin:self.strings.index(b"\0", begin)].decode(), found[1]


class PieceCodec:
    def __init__(self, model: bytes):
        fields = list(_message(model))
        pieces = [dict(_message(v)) for k, v in fields if k == 1]
        trainer = dict(next((v for k, v in ((k, dict(_message(v))) for k, v in fields if k == 2)), {}))
        norm = dict(next((v for k, v in ((k, dict(_message(v))) for k, v in fields if k == 3)), {}))
        if trainer.get(3) != 2:
            raise ValueError("a BPE model is needed")
        if any(p.get(3, NORMAL) == USER for p in pieces):
            raise ValueError("user-defined pieces are not supported")
        self.map = CharacterMap(norm.get(2, b""))
        self.prefix, self.squeeze, self.escape = bool(norm.get(3, 1)), bool(norm.get(4, 1)), bool(norm.get(5, 1))
        self.plain = not self.map.units and not self.squeeze and self.escape
        texts = [p.get(1, b"").decode() for p in pieces]
        kinds = [p.get(3, NORMAL) for p in pieces]
        scores = [struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces]
        self.size = len(pieces)
        self.ids = {t: i for i, (t, k) in enumerate(zip(texts, kinds)) if k == NORMAL}
        self.byte_ids = [i for i, k in enumerate(kinds) if k == BYTE]
        if len(self.byte_ids) != 256:
            raise ValueError("byte pieces are needed")
        named = {v: i for i, v in enumerate(texts)}
        self.bos, self.eos = named["<s>"], named["</s>"]
        # what a piece decodes to, and how many characters it covers
        self.raw = [t.replace(MARK, " ").encode() if k == NORMAL else bytes([int(t[3:5], 16)]) if k == BYTE else b""
                    for t, k in zip(texts, kinds)]
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_size = np.array([len(r) for r in self.raw], np.int32)
        self.raw_begin = np.concatenate([[0], np.cumsum(self.raw_size)[:-1]]).astype(np.int32)
        self.covers = np.array([len(t) if k == NORMAL else 0 for t, k in zip(texts, kinds)], np.int64)
        self.byte_of = np.full(self.size, -1, np.int64)
        self.byte_of[self.byte_ids] = np.arange(256)
        # pairs of symbols that merge, the better score the lower rank
        rank = {s: r for r, s in enumerate(sorted(set(scores), reverse=True))}
        pairs = sorted((self.ids[t[:c]] * _RIGHT + self.ids[t[c:]], i, rank[scores[i]])
                       for t, i in self.ids.items() for c in range(1, len(t)) if t[:c] in self.ids and t[c:] in self.ids)
        self.pair = np.array([p[0] for p in pairs], np.int64)
        self.merged = np.array([p[1] for p in pairs], np.int64)
        self.rank = np.array([p[2] for p in pairs], np.int64)
        self.of_pair = {p[0]: p[1:] for p in pairs}
        self.symbol = np.arange(0x110000, dtype=np.int64) + self.size
        for t, i in self.ids.items():
            if len(t) == 1:
                self.symbol[ord(t)] = i
        inner = {c for t in self.ids if len(t) > 1 for c in t}
        if any(MARK in t.lstrip(MARK) for t in self.ids):
            raise ValueError("pieces with a space inside are not supported")
        alone = "\n" if "\n" not in inner else ""
        self.units_of = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+|{alone}" if alone else f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.table: dict[str, bytes] = {}

    # ------------------------------------------------------------ normalisation
    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its characters and its end, the byte offset in the source."""
        if self.plain:
            if not text:
                return "", np.zeros(1, np.int64)
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            lead = 2 if self.prefix else 1
            offsets = np.zeros(len(points) + lead, np.int64)
            np.cumsum(width, out=offsets[lead:])
            return (MARK if self.prefix else "") + text.replace(" ", MARK), offsets
        return self._mapped(text)

    def _mapped(self, text: str) -> tuple[str, np.ndarray]:
        data, at, out, offsets = text.encode(), 0, [], []
        mark = MARK if self.escape else " "

        def prefix():
            found = self.map.longest(data, at)
            if found:
                return found
            lead = data[at]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return data[at:at + width].decode(), width

        if self.squeeze:
            while at < len(data):
                said, width = prefix()
                if said != " ":
                    break
                at += width
        if at == len(data):
            return "", np.zeros(1, np.int64)
        if self.prefix:
            out.append(mark)
            offsets.append(at)
        after_space = self.squeeze
        while at < len(data):
            said, width = prefix()
            if after_space:
                said = said.lstrip(" ")
            if said:
                out += [mark if c == " " else c for c in said]
                offsets += [at] * len(said)
                after_space = said.endswith(" ")
            at += width
            if not self.squeeze:
                after_space = False
        if self.squeeze:
            while out and out[-1] == mark:
                out.pop()
                at = offsets.pop()
        return "".join(out), np.array([*offsets, at], np.int64)

    # ------------------------------------------------------------ segmentation
    def _written(self, symbols) -> bytes:
        ids: list[int] = []
        for s in symbols:
            ids += [s] if s < self.size else [self.byte_ids[b] for b in chr(s - self.size).encode()]
        return np.array(ids, "<u4").tobytes()

    def _one(self, unit: str) -> bytes:
        """Merges of one unit by a heap of its pairs."""
        symbols = [int(self.symbol[ord(c)]) for c in unit]
        left, right = list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
        heap: list = []

        def push(a, b):
            if a >= 0 and b < len(symbols):
                hit = self.of_pair.get(symbols[a] * _RIGHT + symbols[b])
                if hit:
                    heapq.heappush(heap, (hit[1], a, b, symbols[a], symbols[b], hit[0]))

        for k in range(len(symbols) - 1):
            push(k, k + 1)
        while heap:
            _, a, b, sa, sb, merged = heapq.heappop(heap)
            if symbols[a] != sa or symbols[b] != sb or right[a] != b:
                continue
            symbols[a], symbols[b] = merged, -1
            right[a] = right[b]
            if right[b] < len(symbols):
                left[right[b]] = a
            push(left[a], a)
            push(a, right[a])
        return self._written(s for s in symbols if s >= 0)

    def _ranks(self, a, b):
        """Rank and merged symbol of pairs; where they don't merge, the highest rank."""
        key = a * _RIGHT + b
        at = np.searchsorted(self.pair, key)
        at[at == len(self.pair)] = 0
        hit = (self.pair[at] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.rank[at], _NONE), np.where(hit, self.merged[at], -1)

    def _many(self, units: list[str], length: int) -> None:
        """Merges of units of one length, a merge of each at a time."""
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).reshape(len(units), length)
        done = self.symbol[points]
        if length > 1:
            symbols, rows = done.copy(), np.arange(len(units))
            rank, merged = (x.reshape(len(units), length - 1) for x in self._ranks(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()))
            column = np.arange(length)
            while len(rows):
                best = rank.argmin(axis=1)
                line = np.arange(len(rows))
                go = rank[line, best] != _NONE
                done[rows[~go]] = symbols[~go]
                rows, symbols, rank, merged, best = rows[go], symbols[go], rank[go], merged[go], best[go]
                if not len(rows):
                    break
                line = np.arange(len(rows))
                new = merged[line, best]
                # what stands right of the merged pair moves one place to the left
                closed = np.concatenate([symbols[:, 1:], np.full((len(rows), 1), -1)], axis=1)
                symbols = np.where(column <= best[:, None], symbols, closed)
                symbols[line, best] = new
                pad = lambda x, v: np.concatenate([x[:, 1:], np.full((len(rows), 1), v)], axis=1)
                rank = np.where(column[:-1] < best[:, None], rank, pad(rank, _NONE))
                merged = np.where(column[:-1] < best[:, None], merged, pad(merged, -1))
                for at in (best - 1, best):
                    some = (at >= 0) & (at < length - 1)
                    r, k = line[some], at[some]
                    rank[r, k], merged[r, k] = self._ranks(symbols[r, k], symbols[r, k + 1])
        kept = done >= 0
        flat = done[kept].astype("<u4").tobytes()
        ends = np.cumsum(kept.sum(axis=1)).tolist()
        odd = set(np.flatnonzero((done >= self.size).any(axis=1)).tolist())
        begin = 0
        for k, (unit, end) in enumerate(zip(units, ends)):
            self.table[unit] = self._written(done[k][kept[k]].tolist()) if k in odd else flat[4 * begin:4 * end]
            begin = end

    def learn(self, units) -> None:
        """Encode units that the table lacks."""
        new = [u for u in units if u not in self.table]
        if len(self.table) + len(new) > KEPT_UNITS:
            self.table.clear()
            new = list(units)
        by_length: dict[int, list[str]] = {}
        for u in new:
            by_length.setdefault(len(u), []).append(u)
        for length, same in by_length.items():
            if length <= LONG_UNIT and len(same) > 8:
                for k in range(0, len(same), 20_000):
                    self._many(same[k:k + 20_000], length)
            else:
                for u in same:
                    self.table[u] = self._one(u)

    def encode(self, texts: list[str]):
        """Per text (ids, offsets): ids as an array without begin and end, offsets of the normalised text."""
        split, seen = [], set()
        for text in texts:
            norm, offsets = self.normalise(text)
            units = self.units_of(norm)
            split.append((units, offsets))
            seen.update(units)
        self.learn(seen)
        for units, offsets in split:
            yield np.frombuffer(b"".join(map(self.table.__getitem__, units)), "<u4"), offsets

    # ------------------------------------------------------------ projection, decoding
    def spans(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of every piece in the source's bytes."""
        covers = self.covers[ids]
        byte = self.byte_of[ids]
        lead = np.flatnonzero((byte >= 0) & ((byte < 0x80) | (byte >= 0xC0)))
        first = byte[lead]
        covers[lead + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)] = 1
        ends = np.cumsum(covers)
        return offsets[ends - covers], offsets[ends]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the mark put in front of a text is no part of it."""
        size = self.raw_size[ids]
        ends = np.cumsum(size, dtype=np.int64)
        # byte n of a piece stands n places after the piece's first one, in the text as in the table
        places = np.repeat(self.raw_begin[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        text = self.raw_bytes[places].tobytes().decode("utf-8", "replace")
        if self.squeeze:
            return text.lstrip(" ")
        return text[1:] if self.prefix and text.startswith(" ") else text


_CODECS: dict[str, PieceCodec] = {}


def codec_of(path: str) -> PieceCodec:
    """The worker's codec of a model file; one is kept."""
    if path not in _CODECS:
        _CODECS.clear()
        with open(vocabulary_file(path), "rb") as f:
            _CODECS[path] = PieceCodec(f.read())
    return _CODECS[path]


def _mapped_texts(docs: DataFrame, path: str, row, schema: str, fields: pa.Schema) -> DataFrame:
    def run(batches):
        codec = codec_of(path)
        for doc_ids, texts in gathered(batches, GATHERED_CHARS):
            rows = [row(codec, d, t, ids, offsets) for d, t, (ids, offsets) in zip(doc_ids, texts, codec.encode(texts))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(run, schema)


def encode_spans(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, starts, ends: the pieces of every text and the bytes of it (UTF-8) that they stand for."""
    def row(codec, doc, text, ids, offsets):
        starts, ends = codec.spans(ids, offsets)
        return doc, ids, starts, ends

    fields = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])
    return _mapped_texts(docs, path, row, "doc_id long, ids array<long>, starts array<long>, ends array<long>", fields)


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of rows (doc_id, ids); null ids have no text. Ids of control pieces stand for nothing."""
    def run(batches):
        codec = codec_of(path)
        for batch in batches:
            texts = [None if x is None else codec.decode(np.array(x, np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    prepare(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text with begin and end ids, and n_bytes,
    spans_crc32 (of the pieces' begins and ends in the source, little-endian unsigned 32-bit pairs)."""
    def row(codec, doc, text, ids, offsets):
        begin, end = struct.pack("<I", codec.bos), struct.pack("<I", codec.eos)
        spans = np.stack(codec.spans(ids, offsets), axis=1).astype("<u4")
        return (doc, len(ids) + 2, hashlib.sha256(begin + ids.tobytes() + end).hexdigest(),
                hashlib.sha256(codec.decode(ids).encode()).hexdigest(), int(offsets[-1]), zlib.crc32(spans.tobytes()))

    fields = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string()), ("n_bytes", pa.int64()), ("spans_crc32", pa.int64())])
    return _mapped_texts(docs, path, row, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, "
                         "n_bytes long, spans_crc32 long", fields)
