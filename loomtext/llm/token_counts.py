"""Token counts by prefix dynamic programming over byte-level BPE.

For a pre-token ``b`` the token sequence of every prefix ``b[:k]`` is found in
one pass: exactly one vocabulary token ``t = b[j:k]`` can end it, namely the one
that may follow the last token of ``b[:j]`` (two tokens may follow each other
when merging their joint bytes gives just those two). ``count[k] = count[j] + 1``
is then the exact number of tokens of that prefix. Over a text the counts of
its pieces add up, so the running sum of the stored increments answers "how
many tokens has the first k bytes" and "how much fits a budget" without
encoding anything again.

A text is cut into units (a run of white space and the run of other characters
after it); pre-tokens never cross units. The increments of a unit are computed
once per worker and kept in a table of bounded size.

Defined cases: null text counts as empty (0 tokens); special strings of the
vocabulary are one token each, and inside one the prefix counts are those of
plain text; repeated rows are counted each; other columns are ignored.
"""
from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_symbols, gathered, prepare, vocabulary_file, whole_text

LIMIT = 1024
KEPT_UNITS = 600_000   # of a worker's table; it starts anew beyond
KEPT_PAIRS = 1_000_000
LONG_UNIT = 64         # characters; longer units are computed each time
LONG_PIECE = 24        # bytes; longer pieces are computed one by one,
FEW_PIECES = 20        # and so are pieces whose length few others have
GATHERED_CHARS = 4_000_000  # of texts whose new pieces are computed together

# Fixed values of the byte-level pre-tokenizer: its pattern, its contractions, Unicode white space.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LONG_CONTRACTIONS = (b"'re", b"'ve", b"'ll")
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNITS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_LEAD = re.compile(f"[{SPACE}]*")
# The usual unit: a space or line break or none, letters, marks that can't begin a contraction.
_USUAL = re.compile(r"([ \n]?)([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@\[-`{-~]*)")
_BASE = np.uint64(0x100000001B3)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PrefixCounter:
    def __init__(self, path: str):
        with open(vocabulary_file(path), encoding="utf-8") as f:
            spec = json.load(f)
        of = byte_symbols()
        raw = lambda s: bytes(of[c] for c in s)
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        special = set(self.specials)
        self.tokens = {raw(s) for s in spec["model"]["vocab"] if s not in special}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.starts = {t[:k] for t in self.tokens for k in range(1, len(t) + 1)}
        self.follows: dict[tuple, bool] = {}
        self.units: dict[str, bytes] = {}
        self.pieces: dict[bytes, bytes] = {}
        self.numbered = [b"", *sorted(self.tokens)]
        self.longest = max(map(len, self.numbered))
        self._index_tokens()
        self.pair_keys = np.array([-1], dtype=np.int64)  # sorted pairs that are known, and whether they may follow
        self.pair_good = np.array([False])
        self.new_pairs: dict[int, bool] = {}

    def _index_tokens(self) -> None:
        """Hash table of the tokens, open addressing with linear probing, for lookups by array."""
        bits = max(4, (8 * len(self.numbered)).bit_length())
        self.shift, mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_hash = np.zeros(mask + 1, dtype=np.uint64)
        self.slot_token = np.zeros(mask + 1, dtype=np.int32)
        self.probes = 1
        for number, token in enumerate(self.numbered[1:], 1):
            h = 0
            for byte in token:
                h = (h * int(_BASE) + byte + 1) & 0xFFFFFFFFFFFFFFFF
            at, tries = ((h * int(_SPREAD)) & 0xFFFFFFFFFFFFFFFF) >> (64 - bits), 1
            while self.slot_token[at]:
                at, tries = (at + 1) & mask, tries + 1
            self.slot_hash[at], self.slot_token[at] = h, number
            self.probes = max(self.probes, tries)

    def _tokens_at(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the tokens with these hashes, 0 where there is none."""
        at = ((h * _SPREAD) >> self.shift).astype(np.int64)
        out = np.where(self.slot_hash[at] == h, self.slot_token[at], 0)
        for _ in range(self.probes - 1):
            at = (at + 1) & (len(self.slot_hash) - 1)
            out = np.where((out == 0) & (self.slot_hash[at] == h), self.slot_token[at], out)
        return out

    def _may_follow_at(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        good = self.pair_good[at]
        strange = np.flatnonzero(self.pair_keys[at] != key)
        if len(strange):
            unique, back = np.unique(key[strange], return_inverse=True)
            answers = []
            for k in unique.tolist():
                known = self.new_pairs.get(k)
                if known is None:
                    x, y = self.numbered[k >> 32], self.numbered[k & 0xFFFFFFFF]
                    known = self.new_pairs[k] = self.merged(x + y) == ([x, y] if x else [y])
                answers.append(known)
            good[strange] = np.array(answers)[back]
        return good

    def _keep_pairs(self) -> None:
        if len(self.pair_keys) > KEPT_PAIRS:
            self.pair_keys, self.pair_good = self.pair_keys[:0], self.pair_good[:0]
        keys = np.concatenate([self.pair_keys, np.fromiter(self.new_pairs.keys(), np.int64, len(self.new_pairs))])
        good = np.concatenate([self.pair_good, np.fromiter(self.new_pairs.values(), bool, len(self.new_pairs))])
        order = np.argsort(keys)
        self.pair_keys, self.pair_good = keys[order], good[order]
        self.new_pairs.clear()

    def learn_pieces(self, pieces: set[bytes]) -> None:
        """The same recurrence as ``piece_counts``, for all pieces of a length at once."""
        by_length: dict[int, list[bytes]] = {}
        for p in pieces:
            by_length.setdefault(len(p), []).append(p)
        for n, group in by_length.items():
            if n > LONG_PIECE or len(group) < FEW_PIECES:
                for p in group:
                    self.pieces[p] = np.diff(self.piece_counts(p)).astype("<i2").tobytes()
                continue
            data = np.frombuffer(b"".join(group), dtype=np.uint8).reshape(-1, n).astype(np.uint64) + np.uint64(1)
            last = np.full((n + 1, len(group)), -1, dtype=np.int32)
            last[0] = 0
            count = np.zeros((n + 1, len(group)), dtype=np.int16)
            for j in range(n):
                h = np.zeros(len(group), dtype=np.uint64)
                for k in range(j + 1, min(n, j + self.longest) + 1):
                    h = h * _BASE + data[:, k - 1]
                    token = self._tokens_at(h)
                    rows = np.flatnonzero((token > 0) & (last[k] < 0))
                    if len(rows):
                        rows = rows[self._may_follow_at(last[j, rows], token[rows])]
                        last[k, rows] = token[rows]
                        count[k, rows] = count[j, rows] + 1
            steps = np.ascontiguousarray(np.diff(count, axis=0).T).astype("<i2").tobytes()
            for i, p in enumerate(group):
                self.pieces[p] = steps[2 * n * i:2 * n * (i + 1)]
        if len(self.new_pairs) > len(self.pair_keys) // 20:
            self._keep_pairs()

    def learn(self, texts: list[str]) -> list[list[str]]:
        """Fill the tables with the usual units of these texts; their units."""
        split = [UNITS.findall(t) for t in texts]
        new = set().union(*split).difference(self.units)
        if len(self.units) + len(new) > KEPT_UNITS:
            self.units.clear()
            self.pieces.clear()
            new = set().union(*split)
        usual = []
        for u in new:
            if len(u) <= LONG_UNIT and (m := _USUAL.fullmatch(u)):
                lead, word, marks = m.groups()
                usual.append((u, lead, (lead + word if lead == " " else word).encode(), marks.encode()))
        pieces = {x[2] for x in usual} | {x[3] for x in usual if x[3]}
        pieces.add(b"\n")
        self.learn_pieces(pieces.difference(self.pieces))
        known = self.pieces
        for u, lead, word, marks in usual:
            steps = known[word] + known[marks] if marks else known[word]
            self.units[u] = known[b"\n"] + steps if lead == "\n" else steps
        return split

    def merged(self, data: bytes) -> list[bytes]:
        """Plain merging by rank, of a few bytes: decides which tokens may follow each other."""
        parts = [data[i:i + 1] for i in range(len(data))]
        rank, none = self.rank.get, len(self.rank)
        while True:
            best, at, before = none, -1, parts[0]
            for i in range(1, len(parts)):
                part = parts[i]
                r = rank((before, part), none)
                if r < best:
                    best, at = r, i
                before = part
            if at < 0:
                return parts
            parts[at - 1:at + 1] = [parts[at - 1] + parts[at]]

    def may_follow(self, a: bytes, b: bytes) -> bool:
        known = self.follows.get((a, b))
        if known is None:
            if len(self.follows) > KEPT_PAIRS:
                self.follows.clear()
            known = self.follows[(a, b)] = self.merged(a + b) == ([a, b] if a else [b])
        return known

    def piece_counts(self, piece: bytes) -> list[int]:
        """Tokens of each prefix of a pre-token, from the empty one to all of it."""
        n = len(piece)
        last: list[bytes | None] = [None] * (n + 1)
        count = [0] * (n + 1)
        last[0] = b""
        tokens, starts, follow = self.tokens, self.starts, self.may_follow
        for j in range(n):
            before = last[j]
            for k in range(j + 1, n + 1):
                t = piece[j:k]
                if t not in starts:
                    break
                if last[k] is None and t in tokens and follow(before, t):
                    last[k], count[k] = t, count[j] + 1
        if piece in LONG_CONTRACTIONS:
            count[2] = 2  # cut short, the apostrophe and the letter are pieces of their own
        return count

    def unit_counts(self, unit: str) -> list[int]:
        """Tokens of each byte prefix (without the empty one) of a unit standing at a text's end."""
        lead = _LEAD.match(unit)[0]
        rest = unit[len(lead):]
        out = self.piece_counts(lead.encode("utf-8", "surrogatepass"))[1:] if lead else []
        if not rest:
            return out
        base = 0
        if lead:  # the last white space stands alone or joins the word
            if lead[:-1]:
                base += self.piece_counts(lead[:-1].encode())[-1]
            if lead[-1] == " ":
                rest = " " + rest
            else:
                base += self.piece_counts(lead[-1].encode())[-1]
        for k, piece in enumerate(PIECES.findall(rest)):
            counts = self.piece_counts(piece.encode("utf-8", "surrogatepass"))
            skip = 2 if k == 0 and lead and rest[0] == " " else 1  # that space's prefix is counted above
            out += [base + c for c in counts[skip:]]
            base += counts[-1]
        return out

    def increments(self, unit: str) -> bytes:
        known = self.units.get(unit)
        if known is None:
            counts = np.array(self.unit_counts(unit), dtype=np.int64)
            known = np.diff(counts, prepend=0).astype("<i2").tobytes()
            if len(unit) <= LONG_UNIT:
                if len(self.units) >= KEPT_UNITS:
                    self.units.clear()
                self.units[unit] = known
        return known

    def text_increments(self, text: str, units: list[str] | None = None) -> np.ndarray:
        """One number per byte: what that byte adds to the token count of the prefix it ends."""
        if self.split_special is None or not any(s in text for s in self.specials):
            units = UNITS.findall(text) if units is None else units
            try:
                return np.frombuffer(b"".join(map(self.units.__getitem__, units)), dtype="<i2")
            except KeyError:
                get, fill = self.units.get, self.increments
                return np.frombuffer(b"".join([get(u) or fill(u) for u in units]), dtype="<i2")
        out: list[np.ndarray] = []
        before = ""
        for k, part in enumerate(self.split_special.split(text)):
            units = UNITS.findall(part)
            if k % 2 == 0:
                out += [np.frombuffer(self.increments(u), dtype="<i2") for u in units]
                before = units[-1] if units else ""
            else:
                own = len(part.encode("utf-8"))
                counts = [0, *self.unit_counts(before + part)]
                steps = np.diff(np.array(counts[-own - 1:], dtype=np.int64))
                steps[-1] += 1 - steps.sum()
                out.append(steps.astype("<i2"))
                before = ""
        return np.concatenate(out)


def fit_bytes(data: bytes, steps: np.ndarray, limit: int) -> int:
    """Length of the longest prefix, of whole characters, with at most ``limit`` tokens."""
    counts = np.cumsum(steps, dtype=np.int64)
    starts = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
    ends = np.append(starts[1:], True)
    fit = np.flatnonzero(ends & (counts <= limit))
    return int(fit[-1]) + 1 if len(fit) else 0


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT, prefixes: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit, fit_bytes (the longest prefix
    within the limit) and, on demand, prefix_steps: little-endian 16-bit increments per
    byte, whose running sum is the token count of every prefix."""
    prepare(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
              ("over_limit", pa.bool_()), ("fit_bytes", pa.int64())]
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_bytes long"
    if prefixes:
        fields.append(("prefix_steps", pa.binary()))
        schema += ", prefix_steps binary"

    def run(batches):
        c = counter(tokenizer)
        for ids, texts in gathered(batches, GATHERED_CHARS):
            cols: list[list] = [[] for _ in fields]
            for doc_id, text, units in zip(ids, texts, c.learn(texts)):
                steps, data = c.text_increments(text, units), text.encode("utf-8", "surrogatepass")
                n = int(steps.sum(dtype=np.int64)) if len(steps) else 0
                row = [doc_id, len(data), n, n > limit, fit_bytes(data, steps, limit) if n > limit else len(data)]
                if prefixes:
                    row.append(steps.tobytes())
                for col, v in zip(cols, row):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(cols, fields)],
                                             schema=pa.schema(fields))

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(run, schema)
