"""Best-fit packing with exact-complement hashing.

1. Documents are tokenized where they lie; each becomes pieces of at most
   ``capacity`` ids (only longer documents are cut). A piece is a narrow row.
2. The number of pieces per length (at most ``capacity`` numbers, however many
   documents there are) is all the planner sees. It starts a sequence with the
   longest length left, and fills the gap that remains from an index of the
   sums of one, two and three lengths, kept current as counts run out: a
   combination whose sum is exactly the gap is consumed as often as the
   availability counts allow. What no combination completes is filled best-fit,
   longest fitting length first, ending again in an exact complement where there
   is one. Small pieces can be reserved for gaps that no longer one fits: a
   combination is then taken only if its longest length is the longest that fits.
   Both ways are planned, the one with fewer sequences is taken. Each step gives
   a pattern (lengths side by side) and how many sequences take it.
3. Pieces of one length get ranks (counts per hashed slice, running sums over
   the slices, row numbers inside a slice: no length is ever one task's work),
   and the patterns turn (length, rank) into a sequence and an offset.

Defined cases: null text counts as empty (one piece, the closing id alone);
repeated rows are packed each; a null doc_id is packed like any other; an
empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_symbols, gathered, prepare, scratch_table, vocabulary_file, whole_text

CAPACITY = 2048
END_ID = 0
KEPT_UNITS = 600_000  # of a worker's table; it starts anew beyond
SLICES_PER_PARTITION = 2
GATHERED_CHARS = 1_000_000  # of texts whose new words are looked up together
_ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space to str.split but not to the tokenizer
# Latin letters whose lower case has no rules of its own, then marks that can't begin a contraction.
_LETTERS_AND_MARKS = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@\\[-`{-~]*)")


class UnitEncoder:
    """Ids of texts through the tokenizers library, called once per new word.

    White space separates the tokenizer's words, so the ids of a text are the ids of its
    white-space-separated units side by side. A unit of Latin letters with marks behind it is
    two words of the pre-tokenizer, which go to the library's model as they are; any other new
    unit goes through the whole library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary_file(path))
        self.model = self.tokenizer.model
        self.symbols = {b: ord(c) for c, b in byte_symbols().items()}
        self.units: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def part(self, word: str) -> bytes:
        """Ids of one lower-case word of the pre-tokenizer."""
        known = self.parts.get(word)
        if known is None:
            shown = word.encode().decode("latin-1").translate(self.symbols)
            known = self.parts[word] = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
        return known

    def learn(self, units: set[str]) -> None:
        rest = []
        for u in units:
            m = _LETTERS_AND_MARKS.fullmatch(u)
            if m:
                self.units[u] = self.part(m[1].lower()) + (self.part(m[2]) if m[2] else b"")
            else:
                rest.append(u)
        for u, e in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False)):
            self.units[u] = np.array(e.ids, dtype="<u4").tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [None if _ODD_SPACE.search(t) else t.split() for t in texts]
        known = self.units
        new = set().union(*filter(None, split)).difference(known)
        if len(known) + len(new) > KEPT_UNITS:
            known.clear()
            self.parts.clear()
            new = set().union(*filter(None, split))
        self.learn(new)
        return [self.plain(t) if s is None else b"".join(map(known.__getitem__, s)) for t, s in zip(texts, split)]


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
               ids: bool = False) -> DataFrame:
    """Pieces of each document: doc_id, piece, start, length, ids_crc32 (and the ids on demand)."""
    prepare(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if ids:
        fields.append(("ids", pa.binary()))
        schema += ", ids binary"
    arrow = pa.schema(fields)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        e = encoder(tokenizer)
        for doc_ids, texts in gathered(batches, GATHERED_CHARS):
            cols: list[list] = [[] for _ in fields]
            for doc_id, data in zip(doc_ids, e.encode_all(texts)):
                data += end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at:at + 4 * capacity]
                    row = [doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)]
                    for col, v in zip(cols, row + [part] if ids else row):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(cols, fields)], schema=arrow)

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(run, schema)


class Shelf:
    """Availability counts by length, with the index of one-, two- and three-length sums.

    ``pairs[total]`` is the number of available pairs of lengths of that sum; it follows every change of a count
    from or to none (or one, for a length beside itself). A triple is a length and an indexed pair."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, dtype=np.int64)
        self.pairs = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.add(length, n)

    def add(self, length: int, n: int) -> None:
        old = int(self.count[length])
        new = old + n
        if (old > 0) != (new > 0):
            others = np.flatnonzero(self.count[:self.capacity - length + 1])
            self.pairs[others[others != length] + length] += 1 if new else -1
        if 2 * length <= self.capacity and (old > 1) != (new > 1):
            self.pairs[2 * length] += 1 if new > 1 else -1
        self.count[length] = new

    def largest(self, most: int) -> int:
        at = np.flatnonzero(self.count[:most + 1])
        return int(at[-1]) if len(at) else 0

    def pair(self, total: int) -> tuple[int, ...] | None:
        """Two available lengths of that sum, the larger as large as can be."""
        if total < 2 or not self.pairs[total]:
            return None
        large = np.arange(total - 1, (total - 1) // 2, -1)
        c = self.count
        at = int(((c[large] > 0) & (c[total - large] > 0) & ((large * 2 != total) | (c[large] > 1))).argmax())
        return int(large[at]), int(total - large[at])

    def complement(self, gap: int, least: int = 0) -> tuple[int, ...] | None:
        """One, two or three available lengths whose sum is exactly the gap, the first the longest of them and, of
        several, at least ``least``."""
        if gap <= 0:
            return None
        if self.count[gap]:
            return (gap,)
        if (two := self.pair(gap)) and two[0] >= least:
            return two
        longest = np.arange(gap - 2, max((gap - 1) // 3, least - 1), -1)
        for a in longest[(self.count[longest] > 0) & (self.pairs[gap - longest] > 0)].tolist():
            self.add(a, -1)
            two = self.pair(gap - a)
            self.add(a, 1)
            if two:
                return (a, *two)
        return None

    def take(self, lengths: tuple[int, ...]) -> int:
        """Consume the combination as often as the counts allow."""
        need = {x: lengths.count(x) for x in lengths}
        times = min(int(self.count[x]) // n for x, n in need.items())
        for x, n in need.items():
            self.add(x, -times * n)
        return times


def plan_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence in order, number of such sequences), covering all counts.

    Exact combinations of small pieces starve the gaps of long pieces where these are many, and leave less
    room unused where few lengths repeat: planned with and without reserving small pieces."""
    return min((completed(counts, capacity, reserve) for reserve in (True, False)),
               key=lambda plan: sum(times for _, times in plan))


def completed(counts: dict[int, int], capacity: int, reserve: bool) -> list[tuple[tuple[int, ...], int]]:
    """Exact combinations of up to four lengths, longest first; then the rest, the longest that fits behind, until a
    combination is exactly the gap."""
    shelf, out = Shelf(counts, capacity), []

    def exact(gap: int) -> tuple[int, ...] | None:
        return shelf.complement(gap, shelf.largest(gap) if reserve else 0)

    for length in range(capacity, 0, -1):
        while shelf.count[length]:
            shelf.add(length, -1)
            rest = () if length == capacity else exact(capacity - length)
            shelf.add(length, 1)
            if rest is None:
                break
            out.append(((length, *rest), shelf.take((length, *rest))))
    while (length := shelf.largest(capacity)):
        pattern, gap = [length], capacity - length
        shelf.add(length, -1)
        while gap:
            rest = exact(gap) or ((fit,) if (fit := shelf.largest(gap)) else ())
            if not rest:
                break
            pattern += rest
            gap -= sum(rest)
            for x in rest:
                shelf.add(x, -1)
        for x in pattern:
            shelf.add(x, 1)
        out.append((tuple(pattern), shelf.take(tuple(pattern))))
    return out


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, offset), by first rank."""
    taken: dict[int, int] = {}
    rows: dict[int, list] = {}
    sequence = 0
    for lengths, times in patterns:
        offset = 0
        for x in lengths:
            rows.setdefault(x, []).append((taken.get(x, 0), sequence, offset))
            taken[x] = taken.get(x, 0) + times
            offset += x
        sequence += times
    return {x: np.array(r, dtype=np.int64) for x, r in rows.items()}


def ranked(pieces: DataFrame) -> DataFrame:
    """Add rank, 0 and up within each length, without gathering a length in one task."""
    spark = pieces.sparkSession
    n = SLICES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n)))
    counts = keyed.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    return (keyed.withColumn("row", F.row_number().over(inside).cast("long"))
            .join(first, ["length", "slice"])
            .withColumn("rank", F.col("first") + F.col("row") - 1).drop("slice", "first", "row"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = scratch_table(cut_pieces(docs, tokenizer, capacity, end_id), "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = slots(plan_patterns(histogram, capacity))

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for x in np.unique(length).tolist():
                mine, table = length == x, place[x]
                at = np.searchsorted(table[:, 0], rank[mine], side="right") - 1
                sequence[mine] = table[at, 1] + rank[mine] - table[at, 0]
                offset[mine] = table[at, 2]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in batch.schema.names[:-1]] + [pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    rows = ranked(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                "sequence_id long, offset long")
