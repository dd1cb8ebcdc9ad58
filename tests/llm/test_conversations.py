"""Operators over conversations against brute force on small tables."""
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from loomtext.llm import conversation_repair, conversation_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- repair

def damaged(rows):
    """Rows (conv_id, turn, role, text) of one conversation after the damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        c, t, role, text = (" " if x is None else x for x in (conv, turn, role, text))
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    found, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip(WHITE)
        found.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """Least (cost, audit, repaired lines) over every edit script with up to len(rows) + 2 inserts."""
    done = {"": {(0, "", ())}}  # role initials so far -> scripts
    fits = lambda r: re.fullmatch(r"s?(ua)*u?", r)
    for k in range(len(rows) + 1):
        for _ in range(3):  # inserts
            more = {}
            for roles, scripts in done.items():
                more.setdefault(roles, set()).update(scripts)
                for name in ("user", "assistant"):
                    if fits(roles + name[0]):
                        more.setdefault(roles + name[0], set()).update((c + 5, a + "I", t + (name + ":",)) for c, a, t in scripts)
            done = {r: {min(s, key=lambda x: x[:2])} for r, s in more.items()}
        if k == len(rows):
            break
        _, role, text = rows[k]
        more = {}
        for roles, scripts in done.items():
            ways = [("D", 2, "", ())]
            if found[k] not in ("blank", "duplicate"):
                extra = 5 if found[k] == "truncated" else 0
                ways.append(("K", extra, role[:1], (f"{role}:{text}",)))
                ways += [("R", 1 + extra, n[0], (f"{n}:{text}",)) for n in ("user", "assistant")]
            for letter, cost, initial, line in ways:
                if (letter == "D" or initial) and fits(roles + initial):
                    more.setdefault(roles + initial, set()).update((c + cost, a + letter, t + line) for c, a, t in scripts)
        done = {r: {min(s, key=lambda x: x[:2])} for r, s in more.items()}
    return min((x for r, s in done.items() if re.fullmatch(r"(s?(ua)+)?", r) for x in s), key=lambda x: x[:2])


def repaired(rows):
    rows = damaged(rows)
    found = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, lines = cheapest(rows, found) if rows else (0, "", ())
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"), found.count("duplicate"),
            found.count("truncated"),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit, sha("\n".join(lines)))


def repair_rows(spark, rows, columns=()):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in columns:
        df = df.withColumn(c, F.lit("x"))
    out = [tuple(r) for r in conversation_repair.repair(df).collect()]
    return {r[0]: r[1:] for r in out}, len(out)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0))


def test_repair_of_given_table(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF0001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    convs = {c: in_order([r for r in table if r[0] == c]) for c in {r[0] for r in table}}
    got = {r[0]: tuple(r)[1:] for r in queries.op11_conversation_repair(spark, SF0001).collect()}
    assert got == {c: repaired(rows) for c, rows in convs.items()}


def test_repair_edges(spark, monkeypatch):
    pick = random.Random(7)
    texts = ["Yes.", "no", "", " \n", "Why?", "Well, then!", "x" * 20000 + ".", None]
    rows = []
    for conv in range(40):
        for turn in range(pick.randrange(1, 30)):
            rows.append((conv, turn * 2, pick.choice(["user", "assistant", "system", "tool", "", None, "u", "Assistant"]), pick.choice(texts)))
    rows += [(None, t, "user", "of nobody.") for t in range(3)] + [(50, None, "user", "a."), (50, None, "user", "a."), (50, 3, "assistant", "b.")]
    dropped = next(t for t in range(999) if zlib.crc32(f"60:{t}".encode()) % 20 == 0)
    rows.append((60, dropped, "user", "gone."))
    want = {}
    for c in {r[0] for r in rows}:
        want[c] = repaired(in_order([r for r in rows if r[0] == c]))
    got, n = repair_rows(spark, rows, ("key", "at", "uid", "chunk"))
    assert got == want and n == len(want)
    assert got[60] == (0, 0, 0, 0, 0, 0, "", EMPTY_SHA)
    # the same through many chunks and several rounds of joining
    monkeypatch.setattr(conversation_repair, "CHUNK", 3)
    monkeypatch.setattr(conversation_repair, "FAN", 2)
    assert repair_rows(spark, rows)[0] == want


def test_repair_of_a_long_conversation_and_none(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(150)] + [(2, 5, "user", "same.")] * 500
    got, _ = repair_rows(spark, rows)
    assert got[1] == repaired(rows[:150])
    first = damaged(rows[150:])
    assert got[2][1:4] == (0, len(first) - 1, 0) and len(got[2][6].replace("I", "")) == len(first)
    assert conversation_repair.repair(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_search_is_exact(seed):
    pick = random.Random(seed)
    rows = [(t, pick.choice(["user", "assistant", "system", "tool"]), pick.choice(["a.", "b", "", "c!", "d?", "e."])) for t in range(9)]
    found = faults(rows)
    code = {"blank": 1, "duplicate": 1, "truncated": 2, "": 0}
    items = [(r[1][:1], code[f], 1) for r, f in zip(rows, found)]
    assert conversation_repair.solve(items) == cheapest(rows, found)[:2]


# ---------------------------------------------------------------- prefix trie

def trie(rows):
    """Every node by brute force: (conv_id, depth, parent's, n_convs, n_children, n_leaves, saved_tokens, ends)."""
    convs = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    rebuilt = {}
    for c, own in convs.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = ([] if c is None else convs.get(c - c % 100, [])[:h]) + own[h:]
    order = lambda c: (c is None, c or 0)
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for seq in nodes:
        if seq:
            kids.setdefault(seq[:-1], []).append(seq)
    totals = {}
    for seq in sorted(nodes, key=len, reverse=True):
        below = [totals[k] for k in kids.get(seq, ())]
        saved = (len(nodes[seq]) - 1) * len(seq[-1][1]) if seq else 0
        totals[seq] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    out = []
    for seq, members in nodes.items():
        ends = sorted(c for c in members if len(rebuilt[c]) == len(seq) and c is not None)
        out.append((min(members, key=order), len(seq), min(nodes[seq[:-1]], key=order) if seq else None, len(members),
                    len(kids.get(seq, ())), *totals[seq], sha(",".join(map(str, ends)))))
    return sorted(out, key=repr)


def trie_rows(df):
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in cols) for r in conversation_trie.prefix_nodes(df).collect()), key=repr)


def test_trie_of_given_table(spark):
    df = spark.read.parquet(f"{SF0001}/conversations.parquet")
    assert trie_rows(df) == trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_trie_edges(spark, monkeypatch):
    pick = random.Random(3)
    rows = []
    for conv in [*range(40), 100, 107, 250, 300]:
        for turn in range(pick.choice([1, 2, 3, 7, 12])):
            rows.append((conv, turn * 3, pick.choice(["user", None]), pick.choice(["a", "bb", None, "c" * 3000])))
    rows += [(100 + i, t, "user", f"t{t}") for i in range(1, 60) for t in range(30 if i % 7 else 75)]  # shared long prefixes
    rows += [(None, None, "user", "of nobody"), (None, 1, "user", "of nobody"), (400, 5, "user", "same")]
    rows += [(400, 5, "user", "same")] * 20 + [(333, None, "user", "x"), (333, 0, "user", "y")]
    want = trie(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("k", "c", "depth", "band", "at"):
        df = df.withColumn(c, F.lit("x"))
    assert trie_rows(df) == want
    monkeypatch.setattr(conversation_trie, "BAND", 3)  # several levels of bands
    monkeypatch.setattr(conversation_trie, "BLOCK", 4)
    monkeypatch.setattr(conversation_trie, "ENDS_PIECE", 2)
    assert trie_rows(df) == want
    assert trie_rows(df.limit(0)) == []
