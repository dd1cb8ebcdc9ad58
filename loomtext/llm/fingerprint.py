"""Document fingerprints: a homomorphic multiset hash over paragraphs.

Every paragraph (line) of a text is hashed to a wide vector; the fingerprint is
the sum of the vectors, lane by lane, modulo a power of two. Sums don't depend
on the order of the paragraphs, and a paragraph is inserted or deleted by adding
or subtracting its own vector (``combine``), without the rest of the text.

The vector has three parts:

* 8 lanes of 32 bits from four independent 64-bit hashes, summed modulo 2^32:
  equality of the multisets of paragraphs;
* the number of pieces (clauses: paragraphs parted after punctuation);
* 126 narrow lanes of pieces, three to a word modulo 2^62: each lane counts the
  pieces whose hash has a given bit set. Read as sums of signs, the squared
  difference of two fingerprints estimates how many pieces differ, and
  ``likeness`` is 1 - |f - g|^2 / (|f|^2 + |g|^2), between 0 and 1, with a
  standard error of about one eighth of what differs.

Only Column expressions inside the row: nothing is shuffled to fingerprint.

Defined cases: null text counts as empty (one empty paragraph, no pieces); two
texts without pieces are alike (1) if their fingerprints are equal, else 0;
rows that repeat a doc_id are fingerprinted each, and as a next document the
smallest of their texts and fingerprints stands; the next document of a null
doc_id is none (nothing replaces what is cut off, likeness 0); other columns
are ignored.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.prefix import position
from .common import prepare, scratch_table, whole_text

EQUALITY_SEEDS = (101, 102, 103, 104)
PIECE_SEEDS = (201, 202)
N_WIDE = 2 * len(EQUALITY_SEEDS)
BITS = 21                                    # lanes 0, 21 and 42 of a word
N_PACKED = BITS * len(PIECE_SEEDS)
LENGTH = N_WIDE + 1 + N_PACKED
_LOW32 = (1 << 32) - 1
_LOW62 = (1 << 62) - 1
_LANE = (1 << BITS) - 1
_ONES = 1 | (1 << BITS) | (1 << 2 * BITS)
#: After any mark that is no letter, digit or white space; and at line ends.
PIECE_BORDER = r"(?<=[^\p{L}\p{N}\s])\s+|\s*\n\s*"


def _hashed(parts: Column, seed: int) -> Column:
    return F.transform(parts, lambda p: F.xxhash64(F.lit(seed), p))


def _masked_sum(values: Column, of, mask: int) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, h: (a + of(h)).bitwiseAND(F.lit(mask)))


def with_vector(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the fingerprint vector (array of longs) of the text column."""
    paragraphs = F.split(F.col(text), "\n", -1)
    pieces = F.filter(F.split(F.trim(F.col(text)), PIECE_BORDER, -1), lambda p: p != "")
    df = df.select("*", paragraphs.alias(f"{out}_p"), pieces.alias(f"{out}_c"))
    hashes = {s: _hashed(F.col(f"{out}_p"), s) for s in EQUALITY_SEEDS}
    hashes |= {s: _hashed(F.col(f"{out}_c"), s) for s in PIECE_SEEDS}
    df = df.select("*", *[h.alias(f"{out}_{s}") for s, h in hashes.items()])
    lanes = []
    for s in EQUALITY_SEEDS:
        lanes.append(_masked_sum(F.col(f"{out}_{s}"), lambda h: h.bitwiseAND(F.lit(_LOW32)), _LOW32))
        lanes.append(_masked_sum(F.col(f"{out}_{s}"), lambda h: F.shiftrightunsigned(h, 32), _LOW32))
    lanes.append(F.size(f"{out}_c").cast("long"))
    for s in PIECE_SEEDS:
        for k in range(BITS):
            lanes.append(_masked_sum(F.col(f"{out}_{s}"),
                                     lambda h, k=k: F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_ONES)), _LOW62))
    return (df.withColumn(out, F.array(*lanes))
            .drop(f"{out}_p", f"{out}_c", *[f"{out}_{s}" for s in hashes]))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of the joint paragraphs (sign 1), or of a's without b's (sign -1)."""
    both = F.zip_with(a, b, lambda x, y: x + y if sign > 0 else x - y)
    return F.transform(both, lambda x, i: x.bitwiseAND(F.when(i < N_WIDE, F.lit(_LOW32)).otherwise(F.lit(_LOW62))))


def _packed(v: Column) -> Column:
    return F.slice(v, N_WIDE + 2, N_PACKED)


def _signs(word: Column, n: Column) -> list[Column]:
    """The three lanes of a word as sums of signs over n pieces."""
    return [2 * F.shiftrightunsigned(word, BITS * j).bitwiseAND(F.lit(_LANE)).cast("double") - n for j in range(3)]


def likeness(a: Column, b: Column) -> Column:
    """1 - |a - b|^2 / (|a|^2 + |b|^2) over the sign sums, within 0 and 1."""
    na, nb = F.get(a, N_WIDE).cast("double"), F.get(b, N_WIDE).cast("double")

    def gap(x, y):
        return reduce(lambda p, q: p + q, [(s - t) * (s - t) for s, t in zip(_signs(x, na), _signs(y, nb))])

    def size(x, y):
        return reduce(lambda p, q: p + q, [s * s + t * t for s, t in zip(_signs(x, na), _signs(y, nb))])

    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    apart, whole = total(F.zip_with(_packed(a), _packed(b), gap)), total(F.zip_with(_packed(a), _packed(b), size))
    value = F.when(a == b, 1.0).when(whole == 0, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - apart / whole))
    return F.coalesce(value, F.lit(0.0))


def as_text(v: Column) -> Column:
    """The vector as lowercase hex, 8 digits a wide lane and 16 another."""
    digits = F.transform(v, lambda x, i: F.when(i < N_WIDE, F.lpad(F.lower(F.hex(x)), 8, "0"))
                         .otherwise(F.lpad(F.lower(F.hex(x)), 16, "0")))
    return F.array_join(digits, "")


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id): the next larger id, after the last the first, by places in a distributed prefix
    scan, whose slices follow the ids as they lie."""
    ids = ids.where("doc_id IS NOT NULL").distinct()
    placed = scratch_table(position(ids, ["doc_id"], "at"), "ids")
    first = placed.agg(F.min("doc_id")).first()[0]
    after = placed.select((F.col("at") - 1).alias("at"), F.col("doc_id").alias("next_id"))
    return (placed.join(after, "at", "left")
            .select("doc_id", F.coalesce("next_id", F.lit(first).cast("long")).alias("next_id")))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form.

    The edited form has the last quarter of the code points replaced by as many from the start of
    the next document. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex),
    near_edited, near_next, n_paragraphs."""
    prepare(docs.sparkSession)
    # no cast where none is needed: its alias would keep Spark from seeing that both joins shuffle the same rows
    long_id = F.col("doc_id") if docs.schema["doc_id"].dataType == T.LongType() else F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(long_id, whole_text().alias("text"))
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    named = rows.where("doc_id IS NOT NULL")
    after = scratch_table(next_ids(rows.select("doc_id")), "next")
    need = (named.groupBy("doc_id").agg(F.max(quarter).alias("need"))
            .join(after, "doc_id").select("doc_id", "next_id", "need"))
    # both uses of the texts begin with this join, so that they read one shuffle of them
    dealt = named.join(scratch_table(need.select(F.col("doc_id").alias("before"), F.col("next_id").alias("doc_id"),
                                                 "need"), "need"), "doc_id")
    starts = (dealt.select(F.col("before").alias("doc_id"), F.substring("text", F.lit(1), F.col("need")).alias("start"))
              .groupBy("doc_id").agg(F.min("start").alias("start")))
    edited = F.concat(F.substring("text", F.lit(1), F.char_length("text") - quarter),
                      F.substring(F.coalesce("start", F.lit("")), F.lit(1), quarter))
    both = (dealt.select("doc_id", "text").join(starts, "doc_id", "left")
            .unionByName(rows.where("doc_id IS NULL").withColumn("start", F.lit("")))
            .select("doc_id", "text", edited.alias("edited")))
    both = with_vector(with_vector(both, "text", "f"), "edited", "g")
    done = scratch_table(both.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_paragraphs"), "f", "g"), "fingerprints")
    of_next = (done.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("f").alias("h"))
               .join(after.select(F.col("doc_id").alias("before"), F.col("next_id").alias("doc_id")), "doc_id")
               .select(F.col("before").alias("doc_id"), "h"))
    return (done.join(of_next, "doc_id", "left")
            .select("doc_id", "n_chars", "edited_sha256", as_text(F.col("f")).alias("fingerprint"),
                    as_text(F.col("g")).alias("edited_fingerprint"),
                    likeness(F.col("f"), F.col("g")).alias("near_edited"),
                    likeness(F.col("f"), F.col("h")).alias("near_next"), "n_paragraphs"))
