"""Conversation prefix trie with totals by depth-band rollup.

Every conversation is rebuilt (the first turns of the conversation its hundred begins with, then its
own), and each distinct sequence of first turns is a node. A prefix is known by four running sums of
32-bit hashes of (depth, role, text): sums run by a distributed prefix scan, so a conversation of any
length is many tasks' work, and no text is ever shuffled.

Totals over subtrees go up in bands of ``BAND`` depths:

1. Inside a band, the nodes whose smallest member is conversation c lie one under the other on
   c's path; they are summed along it and explode to the ancestors on the path within the band only
   (at most ``BAND`` rows a path and band), and a grouping adds up what reaches a node.
2. The bands' topmost nodes are a trie of a depth ``BAND`` times less, whose values are the bands' totals; its
   totals come by the same rule, so ``log_BAND(depth)`` levels complete them all.
3. A completed band root then explodes to its ancestors in the band above, which completes every node.

Defined cases: null turns come first, equal turns are ordered by role, then by text digest; null role or text is
empty; repeated rows are turns of their own; rows of a null conv_id are one conversation, not rebuilt, that
comes after all others and is not written in the list of ends; for negative ids c % 100 has the sign of c;
other columns are ignored; an empty table has no nodes.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.prefix import position, prefix_sums
from .common import prepare, scratch_table, stream_sha, whole_text

BAND = 16
HUNDRED = 100
MOST_COPIED = 6     # h is below
BLOCK = 4096        # rows that one step of an explosion makes
ENDS_PIECE = 1024   # ids of one piece of a node's list of ends
NOBODY = (1 << 63) - 1  # stands for a null conv_id
LANES = ("l0", "l1", "l2", "l3")


def _turns(conversations: DataFrame) -> DataFrame:
    """c, at (place, from 0), said (digest of role and text), chars of every original turn."""
    role = whole_text("role")
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NOBODY)).alias("c"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, whole_text()), 256)).alias("said"),
        F.char_length(whole_text()).cast("long").alias("chars"))
    # equal rows are one row with a count until their places are known
    items = rows.groupBy("c", "turn", "role", "said", "chars").agg(F.count(F.lit(1)).alias("n"))
    placed = prefix_sums(items, ["turn", "role", "said"], {"begin": "n"}, ["c"], inclusive=False)
    blocks = placed.select("c", "said", "chars", "n", "begin", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / BLOCK))).alias("block"))
    first, last = F.col("block") * BLOCK, F.least(F.col("block") * BLOCK + BLOCK, F.col("n")) - 1
    return blocks.select("c", "said", "chars", "begin", F.explode(F.sequence(first, last)).alias("i")).select(
        "c", (F.col("begin") + F.col("i")).alias("at"), "said", "chars")


def _rebuilt(turns: DataFrame) -> DataFrame:
    """c, depth (from 0, without a turn), said, chars, ends (the conversation's last) of the rebuilt conversations."""
    own = turns.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    h = F.when(F.col("c") == NOBODY, 0).otherwise(F.crc32(F.col("c").cast("string").cast("binary")) % MOST_COPIED)
    convs = own.select("c", "n", h.alias("h"), (F.col("c") - F.col("c") % HUNDRED).alias("base"))
    base = own.select(F.col("c").alias("base"), F.col("n").alias("n_base"))
    copied = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = convs.join(base, "base", "left").select(
        "c", "base", "h", copied.alias("copied"), (copied + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    convs = scratch_table(convs, "convs")
    heads = turns.where(F.col("c") % HUNDRED == 0).where(F.col("at") < MOST_COPIED - 1).select(
        F.col("c").alias("base"), "at", "said", "chars")
    from_base = (convs.join(heads, "base").where(F.col("at") < F.col("h"))  # at most 100 conversations of 5 turns a base
                 .select("c", (F.col("at") + 1).alias("depth"), "said", "chars", "length"))
    from_own = (turns.join(convs, "c").where(F.col("at") >= F.col("h"))
                .select("c", (F.col("copied") + F.col("at") - F.col("h") + 1).alias("depth"), "said", "chars", "length"))
    root = convs.select("c", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("said"),
                        F.lit(0).cast("long").alias("chars"), "length")
    every = root.unionByName(from_base).unionByName(from_own)
    return every.select("c", "depth", "said", "chars", (F.col("depth") == F.col("length")).alias("ends"))


def _key(depth: Column, lanes: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", *[x.cast("string") for x in (depth, *lanes)]).cast("binary")))


def _paths(conversations: DataFrame) -> DataFrame:
    """c, depth, k (node), pk (its parent), chars, ends."""
    rebuilt = _rebuilt(scratch_table(_turns(conversations), "turns"))
    low = 0xFFFFFFFF
    for i, seed in enumerate((0, 17)):
        h = F.xxhash64(F.lit(seed), "depth", "said")
        rebuilt = (rebuilt.withColumn(f"v{2 * i}", F.when(F.col("depth") == 0, 0).otherwise(h.bitwiseAND(low)))
                   .withColumn(f"v{2 * i + 1}", F.when(F.col("depth") == 0, 0).otherwise(F.shiftrightunsigned(h, 32))))
    values = [f"v{i}" for i in range(4)]
    summed = prefix_sums(rebuilt.drop("said"), ["depth"], dict(zip(LANES, values)), ["c"])
    here = [F.col(x) for x in LANES]
    above = [F.col(x) - F.col(v) for x, v in zip(LANES, values)]
    return summed.select("c", "depth", _key(F.col("depth"), here).alias("k"),
                         F.when(F.col("depth") > 0, _key(F.col("depth") - 1, above)).alias("pk"), "chars", "ends")


def _strips(rows: DataFrame) -> DataFrame:
    """c, band, strip: (depth, k) of a conversation's path inside a band."""
    return (rows.groupBy("c", F.floor(F.col("depth") / BAND).alias("band"))
            .agg(F.sort_array(F.collect_list(F.struct("depth", "k"))).alias("strip")))


def _totals(rows: DataFrame, nodes: DataFrame, deepest: int) -> DataFrame:
    """k, leaves, saved: sums over the subtree of every node. rows: c, depth, k of all paths; nodes: k, c (smallest
    member), depth, leaves, saved (their own)."""
    strips = scratch_table(_strips(rows), "strips")
    # the nodes of a path, in their band, with what they add
    own = (nodes.groupBy("c", F.floor(F.col("depth") / BAND).alias("band"))
           .agg(F.collect_list(F.struct("depth", "leaves", "saved")).alias("own")))
    zero = F.lit(0).cast("long")
    below = lambda x, f: F.aggregate(
        "own", zero, lambda s, v: s + F.when(v["depth"] >= x["depth"], v[f]).otherwise(0))
    lifted = (strips.join(own, ["c", "band"])
              .select(F.explode(F.transform("strip", lambda x: F.struct(
                  x["k"].alias("k"), below(x, "leaves").alias("leaves"), below(x, "saved").alias("saved")))).alias("x"))
              .select("x.*"))
    inside = lifted.groupBy("k").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    if deepest < BAND:
        return inside
    inside = scratch_table(inside, "inside")
    up = lambda df: df.where(F.col("depth") % BAND == 0).withColumn("depth", F.expr(f"depth div {BAND}"))
    roots = up(nodes.select("k", "c", "depth")).join(inside, "k")
    roots = scratch_table(roots, "roots")
    complete = scratch_table(_totals(up(rows.select("c", "depth", "k")), roots, deepest // BAND), "complete")
    # a completed root goes to its ancestors in the band above
    handed = (roots.where("depth > 0").select("k", "c", (F.col("depth") - 1).alias("band")).join(complete, "k").drop("k")
              .join(strips, ["c", "band"]).select(F.explode("strip.k").alias("k"), "leaves", "saved"))
    return inside.unionByName(handed).groupBy("k").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _end_lists(rows: DataFrame) -> DataFrame:
    """k, ends_sha256 of the nodes where conversations end."""
    ends = position(rows.where("ends").where(F.col("c") != NOBODY).select("k", "c"), ["c"], "at", ["k"], start=0)
    pieces = (ends.groupBy("k", F.floor(F.col("at") / ENDS_PIECE).alias("piece"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda c: c.cast("string")), ",").alias("ids")))
    pieces = scratch_table(pieces, "ends")
    long = pieces.where("piece > 0").select("k").distinct()
    short = pieces.join(long, "k", "left_anti").select("k", F.sha2("ids", 256).alias("sha"))
    # a hash is made in order: one task a node, a batch of pieces at a time
    fed = (pieces.join(long, "k", "left_semi").repartition("k").sortWithinPartitions("k", "piece")
           .select(F.hex("k").alias("key"), "ids").mapInArrow(stream_sha(","), "key string, sha string"))
    return short.unionByName(fed.select(F.unhex("key").alias("k"), "sha"))


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    prepare(conversations.sparkSession)
    rows = scratch_table(_paths(conversations), "paths")
    nodes = rows.groupBy("k").agg(F.min("c").alias("c"), F.min("depth").alias("depth"), F.min("pk").alias("pk"),
                                  F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"))
    nodes = scratch_table(nodes, "nodes")
    children = nodes.where("pk IS NOT NULL").groupBy(F.col("pk").alias("k")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "k", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = scratch_table(nodes, "nodes")
    values = nodes.select("k", "c", "depth", (F.col("n_children") == 0).cast("long").alias("leaves"),
                          ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = _totals(rows.select("c", "depth", "k"), values, deepest)
    # inside a path the parent's smallest member is the node's; only a path's top node has to look it up
    tops = nodes.groupBy("c").agg(F.min(F.struct("depth", "k", "pk")).alias("t")).where("t.depth > 0").select("t.k", "t.pk")
    parents = tops.join(nodes.select(F.col("k").alias("pk"), F.col("c").alias("parent")), "pk").select("k", "parent")
    done = nodes.join(totals, "k").join(parents, "k", "left").join(_end_lists(rows), "k", "left")
    some = lambda c: F.when(c != NOBODY, c)
    return done.select(
        some(F.col("c")).alias("conv_id"), "depth",
        F.when(F.col("depth") > 0, some(F.coalesce("parent", "c"))).alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
