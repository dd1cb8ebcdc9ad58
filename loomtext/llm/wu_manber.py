"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the benchmark items' windows of ``width`` consecutive words
(an item of fewer words is one window). Per pattern length the search keeps

* a shift table from a block of two words to the least distance between that
  block and the end of any pattern: positions that cannot end a match are
  skipped without being looked at (a block in no pattern skips ``length - 1``);
* buckets keyed by the last block of the patterns (the block with shift zero);
* the patterns themselves, which confirm a candidate by direct comparison.

Documents are searched where they lie. The benchmark is compiled and sent to the
workers in blocks of at most ``block_chars`` characters of item text (an item is
never cut), one pass over the documents per block: a pass writes its hits by text
to the checkpoint folder and its tables are dropped before the next block, so
that what the driver and a worker hold is bounded however large the benchmark
is. Hits of several passes are merged by text and joined to the documents; with
one block there is one pass and no shuffle of texts.

Defined cases: a null or wordless text has no words and no hits; a null or
wordless item has no window; a repeated item row counts once per distinct
item_id; a null item_id is left out; repeated document rows are scored each;
other columns of the documents are ignored.
"""
from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, scratch_table

WIDTH = 10
BLOCK_CHARS = 8_000_000  # of item text in one pass; about 100 times that in a worker's tables at most

# Bytes of words [0-9a-z and all of UTF-8 beyond ASCII] stay, A-Z are lowered, the rest separates.
_TABLE = bytes((b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32)
               for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class LengthClass:
    """Shift table and suffix buckets of the patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple, list]):
        self.length = length
        self.block = min(2, length)
        self.default = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key, away = pattern[end - self.block:end], length - end
                if away < self.shift.get(key, self.default):
                    self.shift[key] = away
            bucket = self.buckets.setdefault(pattern[length - self.block:], {})
            bucket.setdefault(pattern[0], []).append((pattern, items))

    def search(self, words: list[bytes]):
        """Yield (start, items) of every occurrence."""
        m, n, b = self.length, len(words), self.block
        shift, default, buckets = self.shift.get, self.default, self.buckets
        end = m
        while end <= n:
            key = (words[end - 2], words[end - 1]) if b == 2 else (words[end - 1],)
            step = shift(key, default)
            if step:
                end += step
                continue
            at = end - m
            for pattern, items in buckets[key].get(words[at], ()):
                if tuple(words[at:end]) == pattern:
                    yield at, items
            end += 1


def compile_windows(items: list[tuple[str, str | None]], width: int = WIDTH) -> list[LengthClass]:
    by_length: dict[int, dict[tuple, list]] = {}
    for item_id, text in items:
        words = words_of(text)
        if not words:
            continue
        m = min(width, len(words))
        for i in range(len(words) - m + 1):
            owners = by_length.setdefault(m, {}).setdefault(tuple(words[i:i + m]), [])
            if item_id not in owners:
                owners.append(item_id)
    return [LengthClass(m, p) for m, p in sorted(by_length.items())]


def scan(words: list[bytes], classes: list[LengthClass]) -> tuple[list[tuple[int, int]], set]:
    """Merged [start, end) runs of hit words, and the ids of the items found."""
    spans, found = [], set()
    for c in classes:
        for at, items in c.search(words):
            spans.append((at, at + c.length))
            found.update(items)
    return merge(spans), found


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def _blocks(benchmark: DataFrame, block_chars: int):
    """The distinct items, a bounded block at a time."""
    rows, chars = [], 0
    items = (benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t"))
             .where("i IS NOT NULL AND t IS NOT NULL").distinct())
    for r in items.toLocalIterator():
        if rows and chars + len(r.t) > block_chars:
            yield rows
            rows, chars = [], 0
        rows.append((r.i, r.t))
        chars += len(r.t)
    yield rows


def _text_hashes():
    return F.xxhash64("__text"), F.xxhash64(F.lit(17), "__text")


def _block_hits(texts: DataFrame, block: list[tuple[str, str]], width: int) -> DataFrame:
    """h1, h2 (a text with hits), starts, ends, items: one pass for one block of items, written out."""
    classes = texts.sparkSession.sparkContext.broadcast(compile_windows(block, width))
    arrow = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("starts", pa.list_(pa.int64())),
                       ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])

    def run(batches):
        for batch in batches:
            rows = []
            for h1, h2, text in zip(*(batch.column(i) for i in range(3))):
                spans, found = scan(words_of(text.as_py()), classes.value)
                if spans:
                    rows.append({"h1": h1.as_py(), "h2": h2.as_py(), "starts": [s for s, _ in spans],
                                 "ends": [e for _, e in spans], "items": sorted(found)})
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    h1, h2 = _text_hashes()
    hits = scratch_table(texts.select(h1.alias("h1"), h2.alias("h2"), "__text").mapInArrow(
        run, "h1 long, h2 long, starts array<long>, ends array<long>, items array<string>"), "block")
    classes.destroy()
    return hits


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
               block_chars: int = BLOCK_CHARS, extra: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (the hit
    words as runs [start, end)), and the ``extra`` columns of the documents."""
    spark = prepare(docs.sparkSession)
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("__text"),
                       *(F.col(c) for c in extra))
    schema = T.StructType([kept.schema["doc_id"]] + T._parse_datatype_string(
        "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
        "spans array<struct<start:long,end:long>>").fields + kept.schema.fields[2:])
    arrow = pa.schema([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                       ("items_sha256", pa.string()), ("contaminated", pa.bool_()),
                       ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def rows_of(batch, hits):
        rows = []
        for words, (spans, found) in hits:
            n_hit = sum(e - s for s, e in spans)
            digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
            rows.append({"n_words": len(words), "n_hit": n_hit,
                         "n_items": len(found), "items_sha256": digest, "contaminated": n_hit > 0,
                         "spans": [{"start": s, "end": e} for s, e in spans]})
        out = pa.RecordBatch.from_pylist(rows, schema=arrow)
        return pa.RecordBatch.from_arrays([batch.column(0), *out.columns, *batch.columns[2:2 + len(extra)]], names=schema.names)

    blocks = _blocks(benchmark, block_chars)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        classes = spark.sparkContext.broadcast(compile_windows(block, width))

        def run(batches):
            for batch in batches:
                texts = (words_of(t.as_py()) for t in batch.column(1))
                yield rows_of(batch, ((words, scan(words, classes.value)) for words in texts))

        return kept.mapInArrow(run, schema)

    parts = []
    while block is not None:
        parts.append(_block_hits(kept.select("__text"), block, width))
        block, following = following, next(blocks, None)
    merged = scratch_table(reduce(DataFrame.unionByName, parts).groupBy("h1", "h2").agg(
        F.flatten(F.collect_set(F.arrays_zip("starts", "ends"))).alias("__runs"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("__items")), "hits")
    h1, h2 = _text_hashes()
    joined = kept.join(merged, (h1 == F.col("h1")) & (h2 == F.col("h2")), "left").select(
        *kept.columns, F.col("__runs.starts").alias("__starts"), F.col("__runs.ends").alias("__ends"), "__items")

    def gather(batches):
        for batch in batches:
            marks = [batch.column(c).to_pylist() for c in ("__starts", "__ends", "__items")]
            yield rows_of(batch, ((words_of(t.as_py()), (merge(list(zip(s or (), e or ()))), set(items or ())))
                                  for t, s, e, items in zip(batch.column(1), *marks)))

    return joined.mapInArrow(gather, schema)
