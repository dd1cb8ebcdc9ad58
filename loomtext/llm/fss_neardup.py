"""Near-duplicate classes by fast similarity sketching.

1. A document's set is its distinct k-word shingles, as 64-bit hashes. The
   sketch has t coordinates. In round i every element is thrown into the
   coordinate hash_i(x) mod t with the value (i, hash_i(x)); a coordinate keeps
   its least value, so earlier rounds win. t further rounds throw every element
   into one fixed coordinate each, so that every coordinate is filled whatever
   the size of the set; sets of t log t elements are done in a round or two.
   Two sets agree in a coordinate with the probability of their similarity, with
   concentration as if the coordinates were independent.
2. Equal sets are one class, represented by its smallest doc_id: groups of
   copies never meet in a bucket. ``rows`` coordinates make a band;
   representatives that agree in a band are candidates. With 32 bands of 5 rows
   a pair at similarity 0.8 is missed with probability 3e-6.
3. Candidates are confirmed on their full sets. In every bucket all members are
   first compared with its hub, the member with most bucket mates overall (of
   copies that were edited independently, their original). What is then connected
   need not be compared again. Members of buckets that still hold several
   components meet over their rarest shingles, not over the bucket: sets that are
   similar enough share one of their first ``n - ceil(n p / 100) + 1`` elements in
   any common order, and the order taken here puts first what no other component
   has (it pairs nobody), then the rarer ones. So documents that share much
   boilerplate and are no duplicates never meet. Of those who meet over an element, every
   member outside the largest component is compared with all members of other
   components, unless an exact bound refutes the pair: the parities of how many
   elements fall on each of 2048 bits differ in at most as many bits as there are
   elements that only one of the two sets has. So every candidate pair is confirmed, refuted or known to be
   connected, without listing the pairs of a bucket.
4. Components come from repeated minimum labels with pointer jumping, each round
   written to the shared folder.

Defined cases: null texts and texts without words have the empty set, linked
with nothing; fewer than k words make one shingle; a null doc_id is kept, with
a null component; rows that repeat a doc_id share the smallest component of
their texts; other columns are ignored.
"""
from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.prefix import position
from .common import prepare, scratch_table

SHINGLE = 5
PERCENT = 80
ROWS, BANDS = 5, 32
WORDS = 32  # of parity bits
SEED = np.uint64(0x5851F42D4C957F2D)

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW48 = np.uint64((1 << 48) - 1)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; words are parted by ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(k, n)
    acc = h[:n - width + 1].copy()
    for j in range(1, width):
        acc = mix(acc * _GOLD + h[j:n - width + 1 + j])
    return np.unique(mix(acc + np.uint64(width)))


def sketch(elements: np.ndarray, t: int) -> np.ndarray:
    """t coordinates of a non-empty set; lower values come from earlier rounds."""
    out = np.full(t, _FULL)
    step = max(1, 2048 // len(elements))
    r = 0
    while r < 2 * t:
        rounds = np.arange(r, min(r + step, 2 * t), dtype=np.uint64)
        x = mix(elements[None, :] ^ mix(SEED + rounds * _GOLD)[:, None])
        bins = ((x >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)
        fixed = rounds >= t
        if fixed.any():
            bins[fixed] = (rounds[fixed] - np.uint64(t))[:, None]
        value = (rounds << np.uint64(48))[:, None] | (mix(x) & _LOW48)
        np.minimum.at(out, bins.ravel().astype(np.int64), value.ravel())
        if not (out == _FULL).any():
            break
        r += step
    return out


def bands_of(coordinates: np.ndarray, rows: int) -> np.ndarray:
    """One hash per band of ``rows`` coordinates, with the band's number in it."""
    parts = coordinates.reshape(-1, rows)
    acc = mix(np.arange(len(parts), dtype=np.uint64) * _GOLD + SEED)
    for j in range(rows):
        acc = mix(acc * _GOLD + parts[:, j])
    return acc


def sketches(docs: DataFrame, k: int, rows: int, bands: int) -> DataFrame:
    """doc_id, n (set size), s1 and s2 (128 bits that tell sets apart), bands (null if empty)."""
    schema = "doc_id long, n long, s1 long, s2 long, bands array<long>"
    arrow = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
                       ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            n, s1, s2, found = [], [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), k)
                digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype="<i8")
                n.append(len(s))
                s1.append(int(digest[0]))
                s2.append(int(digest[1]))
                found.append(bands_of(sketch(s, rows * bands), rows).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.array(found, pa.list_(pa.int64()))], schema=arrow)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def parities(elements: np.ndarray) -> np.ndarray:
    """64 * WORDS bits: is the number of elements that fall on the bit odd?"""
    on = np.bincount((mix(elements + SEED) >> np.uint64(32)).astype(np.int64) % (64 * WORDS), minlength=64 * WORDS)
    return np.packbits((on & 1).astype(np.uint8)).view(np.int64)


def least_difference(mine: str, other: str):
    """A lower bound of how many elements only one of two sets has: each changes one parity."""
    return reduce(lambda a, b: a + b, [F.bit_count(F.col(f"{mine}{i}").bitwiseXOR(F.col(f"{other}{i}")))
                                       for i in range(WORDS)])


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """id, size, elements (sorted 64-bit hashes as bytes), parity (their parities)."""
    arrow = pa.schema([("id", pa.int64()), ("size", pa.int64()), ("elements", pa.binary()),
                       ("parity", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t.as_py(), k) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary()),
                 pa.array([parities(s) for s in sets], pa.list_(pa.int64()))], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, "id long, size long, elements binary, parity array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (u, v) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("u"), F.col("size").alias("nu"), F.col("elements").alias("eu"))
    right = sets.select(F.col("id").alias("v"), F.col("size").alias("nv"), F.col("elements").alias("ev"))
    alike = 100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")
    both = pairs.join(left, "u").join(right, "v").where(alike).select("u", "v", "eu", "ev")
    arrow = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        for batch in batches:
            us, vs = [], []
            for u, v, eu, ev in zip(*(batch.column(c) for c in ("u", "v", "eu", "ev"))):
                a = np.frombuffer(eu.as_buffer(), dtype=np.uint64)
                b = np.frombuffer(ev.as_buffer(), dtype=np.uint64)
                at = np.searchsorted(a, b)
                at[at == len(a)] = 0
                shared = int((a[at] == b).sum()) if len(a) else 0
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    us.append(u.as_py())
                    vs.append(v.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], schema=arrow)

    return both.mapInArrow(run, "u long, v long")


def rare_prefixes(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """key, rep, component, size: the elements over which members (rep, component) may meet one of another component."""
    held = sets.select(F.col("id").alias("rep"), "size", "elements").join(members, "rep")

    def run(batches):
        for batch in batches:
            for rep, component, size, elements in zip(*(batch.column(i).to_pylist() for i in range(4))):
                x = np.frombuffer(elements, np.int64)
                for at in range(0, len(x), 65536):  # a long text's set in several batches
                    part = x[at:at + 65536]
                    same = lambda v: pa.array(np.full(len(part), v))  # noqa: E731, B023
                    yield pa.RecordBatch.from_arrays([same(rep), same(component), same(size), pa.array(part)],
                                                     names=["rep", "component", "size", "key"])

    each = scratch_table(held.select("rep", "component", "size", "elements")
                         .mapInArrow(run, "rep long, component long, size long, key long"), "elements")
    # an element of one component only pairs nobody, however many have it
    across = (each.groupBy("key").agg(F.count(F.lit(1)).alias("often"), F.min("component").alias("a"), F.max("component").alias("b"))
              .where("a < b").select("key", "often"))
    across = scratch_table(across, "across")
    own = (each.join(across, "key").groupBy("rep", "component", "size")
           .agg(F.sort_array(F.collect_list(F.struct("often", "key"))).alias("xs")))
    prefix = F.col("size") - F.floor((F.col("size") * percent + 99) / 100) + 1
    take = (prefix - (F.col("size") - F.size("xs"))).cast("int")
    return (own.withColumn("take", take).where("take > 0")
            .select("rep", "component", "size", F.explode(F.slice("xs", F.lit(1), F.col("take"))).alias("x"))
            .select(F.col("x.key").alias("key"), "rep", "component", "size"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    both = scratch_table(both.distinct(), "edges")
    labels = scratch_table(both.groupBy(F.col("u").alias("node"))
                           .agg(F.least(F.min("v"), F.first("u")).alias("component")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "v"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("component").alias("near")))
        step = (labels.join(near, "node").select("node", F.col("component").alias("was"),
                                                 F.least("component", "near").alias("at")))
        # pointer jumping: take over the label of the node that is the label
        jump = labels.select(F.col("node").alias("at"), F.col("component").alias("beyond"))
        new = scratch_table(step.join(jump, "at", "left").select(
            "node", "was", F.least("at", F.coalesce("beyond", "at")).alias("component")), "labels")
        done = new.where("component <> was").limit(1).count() == 0
        labels = new.select("node", "component")
        if done:
            return labels


def link(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """Per document: doc_id, n_shingles, class_id (smallest doc_id with an equal set),
    component_id, kept."""
    prepare(docs.sparkSession)
    drawn = scratch_table(sketches(docs, k, rows, bands), "sketches")
    known = drawn.where("n > 0 AND doc_id IS NOT NULL")
    # Joins back to groups read the groups from a table: a large group's rows can then be split over tasks.
    classes = scratch_table(known.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("high"))
                            .where("rep < high").drop("high"), "classes")
    member = scratch_table(known.join(classes, ["s1", "s2", "n"], "left")
                           .select("doc_id", F.coalesce("rep", "doc_id").alias("rep"), "bands"), "members")
    rep = member.where("doc_id = rep").select("rep", F.explode("bands").alias("key"))
    # buckets of two representatives and more; in each, the member with most bucket mates overall is the hub
    sizes = scratch_table(rep.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "sizes")
    shared = scratch_table(rep.join(sizes, "key"), "buckets")
    mates = shared.groupBy("rep").agg(F.sum("c").alias("mates"))
    hub = scratch_table(shared.join(mates, "rep").groupBy("key")
                        .agg(F.max(F.struct("mates", F.negative("rep").alias("rep"))).alias("m"))
                        .select("key", F.negative("m.rep").alias("hub")), "hubs")
    wanted = shared.select(F.col("rep").alias("doc_id")).distinct()
    sets = scratch_table(full_sets(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                                   .join(wanted, "doc_id", "left_semi"), k), "sets")
    spokes = scratch_table(shared.join(hub, "key").where("rep <> hub")
                           .select(F.least("rep", "hub").alias("u"), F.greatest("rep", "hub").alias("v")).distinct(), "spokes")
    edges = scratch_table(confirmed(spokes, sets, percent), "confirmed")
    first = components(edges)
    # what is left: members of buckets that hold several components, over their rarest elements
    placed = (shared.select("key", "rep").join(first.withColumnRenamed("node", "rep"), "rep", "left")
              .select("key", "rep", F.coalesce("component", "rep").alias("component")))
    open_keys = scratch_table(placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"))
                              .where("a < b").select("key"), "open")
    members = scratch_table(placed.join(open_keys, "key", "left_semi").select("rep", "component").distinct(), "placed")
    bits = [F.get("parity", i).alias(f"p{i}") for i in range(WORDS)]
    placed = scratch_table(rare_prefixes(sets, members, percent)
                           .join(sets.select(F.col("id").alias("rep"), *bits), "rep"), "placed")
    largest = scratch_table(placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
                            .groupBy("key").agg(F.max(F.struct("c", F.negative("component").alias("component"))).alias("m"))
                            .select("key", F.negative("m.component").alias("largest")), "largest")
    outside = scratch_table(placed.join(largest, "key").where("component <> largest")
                            .select("key", F.col("rep").alias("x"), F.col("component").alias("cx"), "largest",
                                    F.col("size").alias("nx"),
                                    *[F.col(f"p{i}").alias(f"q{i}") for i in range(WORDS)]), "outside")
    both = F.col("nx") + F.col("size")
    rest = (outside.join(placed, "key")
            .where((F.col("cx") != F.col("component"))
                   & ((F.col("component") == F.col("largest")) | (F.col("x") < F.col("rep")))
                   & (100 * F.least("nx", "size") >= percent * F.greatest("nx", "size"))
                   # similarity is at least p % where (100 + p) * difference <= (100 - p) * both sizes
                   & ((100 + percent) * least_difference("p", "q") <= (100 - percent) * both))
            .select(F.least("x", "rep").alias("u"), F.greatest("x", "rep").alias("v")).distinct())
    rest = scratch_table(rest.join(spokes, ["u", "v"], "left_anti"), "rest")
    more = scratch_table(confirmed(rest, sets, percent), "confirmed")
    final = components(edges.unionByName(more))
    of = (member.select("doc_id", "rep").distinct().join(final.withColumnRenamed("node", "rep"), "rep", "left")
          .groupBy("doc_id").agg(F.min("rep").alias("rep"), F.min(F.coalesce("component", "rep")).alias("component")))
    return (drawn.join(of, "doc_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("class_id"),
                    F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def numbered_rows(docs: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row per (doc_id, text), with its other ``columns`` (the least ones where they differ), and __row: the
    rows' places by doc_id, null ones last."""
    identity = [F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text") for seed in (0, 17)]
    keyed = docs.select(*columns, identity[0].alias("__h1"), identity[1].alias("__h2"))
    keys = keyed.select("__h1", "__h2", F.col("doc_id").isNull().cast("int").alias("__null"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("__id")).distinct()
    order = position(keys, ["__null", "__id", "__h1", "__h2"], "__row")
    others = [c for c in columns if c not in ("doc_id", "text")]
    # combined in every task before the shuffle, and joined where the shuffle put them
    once = keyed.groupBy("__h1", "__h2").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"),
                                             F.min(F.struct(*others)).alias("__rest"))
    rows = once.join(order.select("__h1", "__h2", "__row"), ["__h1", "__h2"]).select("__row", "doc_id", "text", "__rest.*")
    return scratch_table(rows, "rows")
