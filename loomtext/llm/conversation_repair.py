"""Conversation structure repair by depth-first branch-and-bound.

A conversation is brought to the role order ``(s?(ua)+)?`` (system, user,
assistant initials) by the cheapest edits: Keep 0, Rerole to user or assistant 1,
Delete 2 (forced for blank and repeated rows), Insert an empty user or assistant
row 5; a truncated row that stays adds 5. Of equally cheap edits the ASCII-least
``audit`` (their initials in order) wins.

``solve`` searches depth first on an explicit stack, children in ASCII order. A
prefix is cut when its cost plus the suffix's lower bound (cheapest cost of the
rest from that role state, whatever the audit) passes the incumbent
``(cost, audit)``, or when the dominance table of its node (rows done, role state)
already holds a prefix as good. Equally cheap prefixes of one node are never
prefixes of each other (only inserts differ in number, and they cost), so the
ASCII-less one stays less whatever follows: cutting the other is exact.

Scale: the search reads initials, faults and counts, no texts. Equal rows of a
conversation are one item with a count; items are numbered by a distributed prefix
scan and dealt in chunks of ``CHUNK``. A conversation of one chunk is solved as it
is. Of a longer one, every chunk is solved from every role state to every other,
and the chunks' tables are joined ``FAN`` at a time (cost, audit and order of
concatenated audits allow that), so no task holds more than ``FAN`` chunks but for
the one audit that is the result. Texts meet their edits on a row digest, and pieces of a chunk
are joined; the hash of a longer conversation is fed piece by piece in order.

Defined cases: null conv_id, role and text read as one space (rows of a null conv_id are one
conversation; it is returned as null); null turns come first; rows of one turn are
ordered by role, then by digest; repeated rows are rows of their own; an empty role has
no initial; other columns are ignored, whatever their names; an empty table gives no rows.
"""
from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.prefix import position
from .common import prepare, scratch_table, stream_sha

CHUNK = 64
FAN = 32
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
SPACE = " \t\n\x0b\x0c\r"
# role states: 0 nothing yet, 1 after s, 2 after u, 3 after a
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}  # by the one user or assistant row that can follow
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")
FORCED, CUT = 1, 2  # faults: blank or repeated; truncated


def moves(item, state: int):
    """(letters, cost, next state) of what can be done with an item, in ASCII order of the letters."""
    initial, fault, n = item
    yield "D" * n, DELETE * n, state
    if fault != FORCED:
        rest, cost = "D" * (n - 1), DELETE * (n - 1) + (TRUNCATED if fault == CUT else 0)
        if (state, initial) in KEPT:
            yield "K" + rest, cost, KEPT[state, initial]
        yield "R" + rest, cost + REROLE, NEXT[state]


def suffix_bounds(items, ends) -> list[list[float]]:
    """[rows done][state]: the least cost of what is left, audits aside."""
    bounds = [[0 if s in ends else float("inf") for s in NEXT]]
    for k in range(len(items), -1, -1):
        row = bounds[-1] if k == len(items) else [
            min(cost + bounds[-1][to] for _, cost, to in moves(items[k], s)) for s in NEXT]
        for _ in NEXT:  # inserts before this row, as many as help
            row = [min(row[s], INSERT + row[NEXT[s]]) for s in NEXT]
        if k == len(items):
            bounds[0] = row
        else:
            bounds.append(row)
    return bounds[::-1]


def solve(items, start: int = 0, ends=ENDS):
    """The least (cost, audit) from role state ``start`` to one of ``ends`` over items
    (initial, fault, count); None where there is none."""
    bounds = suffix_bounds(items, ends)
    incumbent = (bounds[0][start], None)
    if incumbent[0] == float("inf"):
        return None
    best: dict[tuple[int, int], tuple[float, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        k, state, cost, audit = stack.pop()
        if cost + bounds[k][state] > incumbent[0]:
            continue
        if incumbent[1] is not None and (cost + bounds[k][state], audit) >= incumbent:
            continue
        if (k, state) in best and best[k, state] <= (cost, audit):
            continue
        best[k, state] = (cost, audit)
        if k == len(items) and state in ends and (incumbent[1] is None or (cost, audit) < incumbent):
            incumbent = (cost, audit)
        after = [(k, NEXT[state], cost + INSERT, audit + "I")]
        if k < len(items):
            after += [(k + 1, to, cost + c, audit + letters) for letters, c, to in moves(items[k], state)]
        stack += sorted(after, key=lambda x: x[3], reverse=True)
    return incumbent


def illegal_pairs(items) -> int:
    """Neighbouring rows whose role initials may not follow each other; equal rows never may."""
    return sum(n - 1 for _, _, n in items) + sum(a[0] + b[0] not in LEGAL for a, b in zip(items, items[1:]))


def edit_lines(audit: str, counts, done: int, has_system: bool):
    """Per item of these counts, where ``done`` rows of the result precede: roles inserted before it, its own
    fate ("K", "R" or "D") and role if reroled, roles inserted after it (only the last one's)."""
    role = lambda j: ("assistant", "user")[(j % 2) == int(has_system)]
    out, at, j = [], 0, done
    for n in counts:
        before = []
        while audit[at] == "I":
            before.append(role(j))
            at, j = at + 1, j + 1
        fate = audit[at]
        out.append([before, fate, role(j) if fate == "R" else None, []])
        j += fate != "D"
        at += n
    while at < len(audit):
        out[-1][3].append(role(j))
        at, j = at + 1, j + 1
    return out


# ---------------------------------------------------------------- rows

def damage(conversations: DataFrame) -> DataFrame:
    """key, turn, role, text, copies: rows after the damage that crc32(``conv_id:turn``) % 20 says."""
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("long")
    kind = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    rows = conversations.select(_key(conv).alias("key"), turn.alias("turn"), space(F.col("role")).alias("role"),
                                space(F.col("text")).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.where("kind <> 0").select(
        "key", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def _key(conv: Column) -> Column:
    return F.when(conv.isNull(), "").otherwise(F.concat(F.lit("="), conv))


def _digest(*parts: Column) -> Column:
    """SHA-256 of the parts, each with its length, so that no two lists are written alike."""
    return F.unhex(F.sha2(F.concat_ws("|", *[F.concat_ws(":", F.length(p).cast("string"), p) for p in parts]), 256))


def _known(rows: DataFrame) -> DataFrame:
    """The rows with said, the digest of role and text, and uid, that of the whole row."""
    said = rows.withColumn("said", _digest(F.col("role"), F.col("text")))
    return said.withColumn("uid", _digest(F.col("key"), F.coalesce(F.col("turn").cast("string"), F.lit("")), F.hex("said")))


def _items(rows: DataFrame) -> DataFrame:
    """One row per different row of a conversation, without texts: key, turn, at (place in the conversation),
    uid, initial, n, blank, fault."""
    told = F.rtrim("text", F.lit(SPACE))
    # equal rows are counted in every task before the shuffle
    items = (_known(rows).select("key", "turn", "role", "said", "uid", "copies", F.substring("role", 1, 1).alias("initial"),
                                 (told == "").alias("blank"), (~F.substring(told, -1, 1).isin(".", "!", "?")).alias("cut"))
             .groupBy("key", "turn", "role", "said", "uid", "initial", "blank", "cut").agg(F.sum("copies").alias("n")))
    numbered = position(items, ["turn", "role", "said"], "at", ["key"], start=0)
    first = (numbered.where("NOT blank").groupBy(F.col("key").alias("k1"), "said").agg(F.min("at").alias("a1"))
             .select("k1", "a1", F.lit(True).alias("new")))
    fresh = numbered.join(first, (F.col("key") == F.col("k1")) & (F.col("at") == F.col("a1")), "left")
    fault = F.when(F.col("new").isNull(), FORCED).when(F.col("cut"), CUT).otherwise(0)
    return fresh.select("key", "turn", "at", "uid", "initial", "n", "blank", fault.alias("fault"))


def _counts(items: DataFrame) -> DataFrame:
    """key, gaps, blank, duplicate, truncated, last (place of the last item)."""
    turns = (items.groupBy("key", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("fault") == FORCED, F.col("n")).otherwise(F.col("n") - 1)).alias("duplicate"),
        F.sum((F.col("fault") == CUT).cast("long")).alias("truncated"), F.max("at").alias("last")))
    return turns.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.max("last").alias("last"))


_EDITS = "array<struct<i:int,before:array<string>,fate:string,role:string,after:array<string>>>"
_PIECE = f"key string, chunk long, edits {_EDITS}"
_SOLVED = f"key string, chunk long, cost long, audit string, illegal long, edits {_EDITS}"
_TABLE = "array<struct<s:int,t:int,cost:long,audit:string>>"
_PART = f"key string, chunk long, paths {_TABLE}, first string, last string, illegal long, sizes array<long>"


def _triples(items):
    return [(x["initial"], x["fault"], x["n"]) for x in items]


def _edits_of(audit, items, done, has_system):
    lines = edit_lines(audit, [x["n"] for x in items], done, has_system)
    return [{"i": i, "before": b, "fate": f, "role": r, "after": a} for i, (b, f, r, a) in enumerate(lines)]


def _has_system(audit: str) -> bool:
    return (len(audit) - audit.count("D")) % 2 == 1


def _arrow(schema: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    return to_arrow_schema(_parse_datatype_string(schema))


def _mapped(df: DataFrame, row, schema: str) -> DataFrame:
    """``row`` of every row's dict (a list of dicts), as Arrow batches."""
    out = _arrow(schema)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pylist([x for r in batch.to_pylist() for x in row(r)], schema=out)

    return df.mapInArrow(run, schema)


def _solve_whole(r):
    items = _triples(r["items"])
    cost, audit = solve(items)
    yield {"key": r["key"], "chunk": 0, "cost": cost, "audit": audit, "illegal": illegal_pairs(items),
           "edits": _edits_of(audit, r["items"], 0, _has_system(audit))}


def _solve_part(r):
    items = _triples(r["items"])
    found = {(s, t): solve(items, s, (t,)) for s in NEXT for t in NEXT}
    yield {"key": r["key"], "chunk": r["chunk"], "first": items[0][0], "last": items[-1][0],
           "illegal": illegal_pairs(items), "sizes": [sum(n for _, _, n in items)],
           "paths": [{"s": s, "t": t, "cost": x[0], "audit": x[1]} for (s, t), x in found.items() if x]}


def _join_parts(r):
    parts = r["parts"]
    table = lambda p: {(x["s"], x["t"]): (x["cost"], x["audit"]) for x in p["paths"]}
    paths = table(parts[0])
    for p in parts[1:]:
        joined: dict = {}
        for (s, m), (c1, a1) in paths.items():
            for (m2, t), (c2, a2) in table(p).items():
                if m2 == m:
                    way = (c1 + c2, a1 + a2)
                    joined[s, t] = min(joined.get((s, t), way), way)
        paths = joined
    illegal = sum(p["illegal"] for p in parts) + sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:]))
    yield {"key": r["key"], "chunk": r["chunk"], "first": parts[0]["first"], "last": parts[-1]["last"],
           "illegal": illegal, "sizes": [n for p in parts for n in p["sizes"]],
           "paths": [{"s": s, "t": t, "cost": c, "audit": a} for (s, t), (c, a) in paths.items()]}


def _choose(r):
    cost, audit = min((x["cost"], x["audit"]) for x in r["paths"] if x["s"] == 0 and x["t"] in ENDS)
    yield {"key": r["key"], "cost": cost, "audit": audit, "illegal": r["illegal"], "sizes": r["sizes"]}


def _cut_audit(r):
    """An audit's piece of every chunk; inserts go with the row after them, the last ones with the last row."""
    audit, sizes, at, done = r["audit"], r["sizes"], 0, 0
    for chunk, n in enumerate(sizes):
        end, rows = at, 0
        while end < len(audit) and (rows < n or chunk + 1 == len(sizes)):
            rows += audit[end] != "I"
            end += 1
        piece = audit[at:end]
        yield {"key": r["key"], "chunk": chunk, "piece": piece, "done": done, "has_system": _has_system(audit)}
        at, done = end, done + len(piece) - piece.count("D")


def _piece_edits(r):
    yield {"key": r["key"], "chunk": r["chunk"], "edits": _edits_of(r["piece"], r["items"], r["done"], r["has_system"])}


def _long(chunks: DataFrame, last_chunk: int) -> tuple[DataFrame, DataFrame]:
    """(key, cost, audit, illegal) and (key, chunk, edits) of conversations of several chunks."""
    joined = scratch_table(_mapped(chunks, _solve_part, _PART), "parts")
    while last_chunk:
        groups = (joined.groupBy("key", F.floor(F.col("chunk") / FAN).alias("up"))
                  .agg(F.sort_array(F.collect_list(F.struct("chunk", "paths", "first", "last", "illegal", "sizes"))).alias("parts")))
        joined = scratch_table(_mapped(groups.select("key", F.col("up").alias("chunk"), "parts"), _join_parts, _PART), "parts")
        last_chunk //= FAN
    best = scratch_table(_mapped(joined, _choose, "key string, cost long, audit string, illegal long, sizes array<long>"), "audits")
    pieces = _mapped(best, _cut_audit, "key string, chunk long, piece string, done long, has_system boolean")
    edits = _mapped(chunks.join(pieces, ["key", "chunk"]), _piece_edits, _PIECE)
    return best.drop("sizes"), edits


def _line(own: Column) -> Column:
    """What stands for an item in the result, null where nothing does."""
    empty = lambda roles: F.transform(roles, lambda r: F.concat(r, F.lit(":")))
    lines = F.concat(empty(F.col("e.before")), F.filter(F.array(own), lambda x: x.isNotNull()), empty(F.col("e.after")))
    return F.when(F.size(lines) > 0, F.array_join(lines, "\n"))


def _repaired(rows: DataFrame, items: DataFrame, edits: DataFrame) -> DataFrame:
    """key, sha: of conversations of which something stays."""
    each = edits.select("key", "chunk", "long", F.explode("edits").alias("e"))
    fates = (each.select(F.col("key").alias("k2"), "chunk", "long", (F.col("chunk") * CHUNK + F.col("e.i")).alias("a2"), "e")
             .join(items.select("key", "at", "uid"), (F.col("key") == F.col("k2")) & (F.col("at") == F.col("a2"))))
    texts = (_known(rows).select("uid", "role", "text").groupBy("uid")
             .agg(F.first("role").alias("own_role"), F.first("text").alias("text")))
    own = F.when(F.col("e.fate") != "D", F.concat(F.coalesce("e.role", "own_role"), F.lit(":"), F.col("text")))
    lines = (texts.join(fates, "uid").select("key", "chunk", "long", "at", _line(own).alias("line")).where("line IS NOT NULL"))
    pieces = (lines.groupBy("key", "chunk", "long").agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("ls"))
              .select("key", "chunk", "long", F.array_join(F.col("ls.line"), "\n").alias("piece")))
    pieces = scratch_table(pieces, "pieces")
    short = pieces.where("NOT long").select("key", F.sha2("piece", 256).alias("sha"))
    # a hash is made in order: one task a conversation, a batch of pieces at a time
    fed = pieces.where("long").repartition("key").sortWithinPartitions("key", "chunk").select("key", "piece")
    return short.unionByName(fed.mapInArrow(stream_sha("\n"), "key string, sha string"))


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conv_id."""
    prepare(conversations.sparkSession)
    rows = damage(conversations)
    items = scratch_table(_items(rows), "items")
    counts = scratch_table(_counts(items), "counts")
    # the search sees initials, faults and counts only
    chunks = (items.groupBy("key", F.floor(F.col("at") / CHUNK).alias("chunk"))
              .agg(F.sort_array(F.collect_list(F.struct("at", "initial", "fault", "n"))).alias("items"))
              .join(counts.select("key", (F.col("last") >= CHUNK).alias("long")), "key"))
    chunks = scratch_table(chunks, "chunks")
    whole = scratch_table(_mapped(chunks.where("NOT long").select("key", "items"), _solve_whole, _SOLVED), "solved")
    solved = whole.select("key", "cost", "audit", "illegal")
    edits = whole.select("key", "chunk", F.lit(False).alias("long"), "edits")
    last = counts.agg(F.max("last")).first()[0] or 0
    if last >= CHUNK:
        best, more = _long(chunks.where("long").select("key", "chunk", "items"), last // CHUNK)
        solved = solved.unionByName(best)
        edits = edits.unionByName(more.withColumn("long", F.lit(True)))
    keys = conversations.select(_key(F.col("conv_id").cast("string")).alias("key")).distinct()
    done = (keys.join(counts.drop("last"), "key", "left").join(solved, "key", "left")
            .join(_repaired(rows, items, edits), "key", "left"))
    conv = F.when(F.col("key") != "", F.substr("key", F.lit(2))).cast(conversations.schema["conv_id"].dataType)
    return done.select(conv.alias("conv_id"),
                       *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                         for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
