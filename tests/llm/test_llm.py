"""Training-data operators: edge cases and brute force on small tables."""
import bisect
import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark import Broadcast
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF0001
from loomtext.llm import (chat_rotation, fingerprint, fss_neardup, html_template, license_scan, line_spread, packing,
                          pu_quality, queries, token_counts, wu_manber)

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LONG = "der lange text, " * 3000
# ids, nulls, empties, ties, repeated rows, and columns whose names the operators use inside
ROWS = [(1, "the mit license\nand the apache license holds here", "a"), (2, None, "b"), (3, "", None), (4, "one", "c"),
        (4, "one", "c"), (5, LONG, "d"), (6, "Straße  naïve\t\n\n''re don't we'll <|endoftext|> x", "a"),
        (None, "no id at all", "a"), (7, "one", "e"), (8, "   \n ", "f")]
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    return (spark.createDataFrame(ROWS, SCHEMA).withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text"))
            .withColumn("k", F.lit(1)).withColumn("pos", F.lit(2)).withColumn("rep", F.lit(3)).withColumn("score", F.lit("x")))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA + ", lang string, n_chars int")


def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    mine = queries.QUERIES[name](spark, SF0001)
    cols = sorted(mine.columns)
    theirs = duck().execute(queries.ORACLES[name])
    at = [[d[0] for d in theirs.description].index(c) for c in cols]
    key = lambda r: repr(r)
    assert sorted([tuple(r[c] for c in cols) for r in mine.collect()], key=key) == \
        sorted([tuple(r[i] for i in at) for r in theirs.fetchall()], key=key)


def test_fingerprint(spark, docs, empty):
    rows = fingerprint.edited_fingerprints(docs).collect()
    assert len(rows) == len(ROWS)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    texts = {1: ROWS[0][1], 2: "", 3: "", 4: "one", 5: LONG, 6: ROWS[6][1], 7: "one", 8: ROWS[9][1]}
    ids = sorted(texts)
    for i, k in enumerate(ids):
        t, n = texts[k], texts[ids[(i + 1) % len(ids)]]
        q = len(t) // 4
        for r in by[k]:
            assert r.n_chars == len(t)
            assert r.edited_sha256 == hashlib.sha256((t[:len(t) - q] + n[:q]).encode()).hexdigest()
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert by[4][0].fingerprint == by[7][0].fingerprint != by[1][0].fingerprint
    assert by[2][0].fingerprint == by[3][0].fingerprint and by[2][0].near_next == 1
    assert fingerprint.edited_fingerprints(empty).count() == 0


def test_fingerprint_is_homomorphic(spark):
    df = spark.createDataFrame([("a b.\nc, d\ne", "e\na b.\nc, d", "a b.", "c, d\ne")], "x string, y string, u string, v string")
    for c in "xyuv":
        df = fingerprint.with_vector(df, c, f"f{c}")
    r = df.select("fx", "fy", fingerprint.combine(F.col("fu"), F.col("fv")).alias("joint"),
                  fingerprint.combine(F.col("fx"), F.col("fv"), -1).alias("less"), "fu",
                  fingerprint.likeness(F.col("fx"), F.col("fy")).alias("same")).first()
    assert r.fx == r.fy == r.joint and r.less == r.fu and r.same == 1


def test_line_spread(spark, docs, empty):
    rows = [(i, f"own line {i} that is long enough to be most of it\nshared footer", f"s{i % 6}") for i in range(12)]
    rows += [(20 + i, "copied page", f"s{i}") for i in range(6)] + [(40, "in one site", "s0")] * 9 + [(50, None, "s1")]
    out = {(r.doc_id, r.text) for r in line_spread.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(12):
        own = f"own line {i} that is long enough to be most of it"
        assert (i, own if i else own + "\nshared footer") in out  # the first one keeps the line
    assert all((20 + i, "copied page") in out for i in range(6))  # mostly spread lines: a copy, left whole
    assert (40, "in one site") in out and (50, None) in out
    kept = line_spread.remove_spread(docs, min_sites=2)
    assert set(docs.columns) <= set(kept.columns) and kept.count() == len(ROWS)
    assert line_spread.report(empty).count() == 0


def test_line_dedup_of_short_pages(spark, empty):
    """Boilerplate goes from pages that are mostly boilerplate; full copies alone are left to near-dedup."""
    foot = "a footer that is longer than the page's own words"
    rows = [(i, f"own {i}\n{foot}", f"s{i}") for i in range(8)] + [(30, foot, "s1"), (31, f"{foot}\n ", "s2")]
    rows += [(40 + i, f"one page\n{foot}", f"s{i}") for i in range(6)] + [(None, foot + "\n\n", "s3")] * 2
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("lang", F.lit("en"))
    out = collections.Counter((r.doc_id, r.text) for r in corpus_pipeline.line_dedup(spark, docs, SF0001).collect())
    want = [(0, f"own 0\n{foot}")] + [(i, f"own {i}") for i in range(1, 8)] + [(30, ""), (31, " ")]
    want += [(40 + i, f"one page\n{foot}") for i in range(6)] + [(None, foot + "\n\n")] * 2
    assert out == collections.Counter(want)


def test_license_scan(docs, empty):
    out = license_scan.scan(docs).collect()
    assert len(out) == len(ROWS)
    first = next(r for r in out if r.doc_id == 1)
    assert (first.n_words, first.n_base, first.first_word, first.last_word) == (9, 2, 1, 5)
    assert first.base_labels == "apache,mit" and first.score == 1
    assert all(r.n_base == 0 and r.first_word is None and r.base_labels == "" for r in out if r.doc_id != 1)
    assert license_scan.scan(empty).count() == 0


def test_license_notice_survives_an_edit(spark):
    words = license_scan.NOTICES["mit-notice"].split()
    text = "intro words " + " ".join(words[:9] + ["inserted"] + words[9:]).title()
    r = license_scan.scan(spark.createDataFrame([(1, text, "a")], SCHEMA)).first()
    assert r.labels == "mit-notice" and r.base_labels == "" and 0.6 <= r.score <= 1 and r.n_spans == 1


def test_chat_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 200, "ann", "x" * 300),
            (1, 200, "ann", "x" * 300), (2, 0, "system", "alone"), (3, None, None, "who"), (None, 1, "eve", "lost")]
    out = chat_rotation.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
                               .withColumn("chunk", F.lit("own"))).collect()
    whole = collections.defaultdict(list)
    for r in out:
        whole[(r.conv_id, r.perspective)].append(r)
    assert set(whole) == {(1, "ann"), (1, "bob"), (3, "unknown"), (None, "eve")}
    for (_, who), rs in whole.items():
        text = ""
        for r in sorted(rs, key=lambda r: r.start):
            assert r.start == len(text)
            text += r.segment
            assert r.end == len(text) and r.trained == (r.speaker == who)
        for r in rs:
            if r.trained:
                assert text[r.mask_start:r.mask_end].endswith("<|im_end|>")
        assert text.count("<|im_end|>") == len(rs)
    assert len(whole[(1, "ann")]) == 5


def test_packing(docs, empty):
    out = packing.pack(docs, WORD).collect()
    t = Tokenizer.from_file(WORD)
    want = collections.Counter()
    for k, text, _ in ROWS:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for j, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a:a + 2048]
            want[(k, j, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    by = collections.defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(empty, WORD).count() == 0


def test_packing_plan():
    rng = np.random.default_rng(1)
    counts = dict(collections.Counter(rng.integers(1, 900, 5000).tolist()))
    plan = packing.plan_patterns(dict(counts))
    used = collections.Counter()
    for lengths, times in plan:
        assert sum(lengths) <= 2048 and times > 0
        for x in lengths:
            used[x] += times
    assert used == counts
    total = sum(k * n for k, n in counts.items())
    assert sum(n for _, n in plan) <= 1.01 * total / 2048 + 1


def _best_fit_decreasing(lengths):
    """Sorted room of the sequences."""
    gaps: list[int] = []
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, x)
        room = gaps.pop(at) if at < len(gaps) else 2048
        bisect.insort(gaps, room - x)
    return gaps


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_packing_plan_of_long_pieces(seed):
    """Half of the lengths need a sequence each: no more sequences than best-fit decreasing."""
    lengths = sorted(np.random.default_rng(seed).integers(1, 2049, 5000).tolist(), reverse=True)
    counts = dict(collections.Counter(lengths))
    plan = packing.plan_patterns(dict(counts))
    used = collections.Counter()
    for pattern, times in plan:
        assert sum(pattern) <= 2048 and times > 0
        for x in pattern:
            used[x] += times
    assert used == counts
    assert sum(n for _, n in plan) <= len(_best_fit_decreasing(lengths))


def test_packing_index():
    """Pairs of the index and complements against brute force, as counts run out."""
    rng = np.random.default_rng(4)
    shelf = packing.Shelf(dict(collections.Counter(rng.integers(1, 41, 60).tolist())), 40)
    while (x := shelf.largest(40)):
        have = [n for n in range(1, 41) for _ in range(min(int(shelf.count[n]), 3))]
        sums = [{c for c in itertools.combinations(have, r)} for r in (1, 2, 3)]
        for gap in range(1, 41):
            assert shelf.pairs[gap] == sum(sum(c) == gap for c in sums[1])
            fits = [c for r in sums for c in r if sum(c) == gap]
            for least in (0, shelf.largest(gap)):
                got = shelf.complement(gap, least)
                ok = [c for c in fits if len(c) == 1 or max(c) >= least]
                assert (tuple(sorted(got)) in ok) if got else not ok
        shelf.take((int(rng.choice(have)),))


def test_packing_few_lengths():
    """Where few lengths repeat, exact combinations of small pieces need fewer sequences than best fit (824)."""
    lengths = np.random.default_rng(7).choice([1100, 700, 650, 300, 290, 48], 3000).tolist()
    plan = packing.plan_patterns(dict(collections.Counter(lengths)))
    assert sum(n * len(p) for p, n in plan) == 3000
    assert sum(n for _, n in plan) < 0.98 * len(_best_fit_decreasing(lengths))


def test_token_counts(docs, empty):
    t = Tokenizer.from_file(BYTE)
    out = token_counts.count_tokens(docs, BYTE, limit=8, prefixes=True).collect()
    want = collections.Counter((k, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for k, x, _ in ROWS)
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in out) == want
    assert all(r.over_limit == (r.n_tokens > 8) for r in out)
    for r in out:
        text = next((x or "" for k, x, _ in ROWS if k == r.doc_id))
        if len(text) < 200:
            counts = np.frombuffer(bytes(r.prefix_steps), "<i2").cumsum()
            fits = 0
            for n in range(1, len(text) + 1):
                prefix = text[:n]
                tokens = len(t.encode(prefix, add_special_tokens=False).ids)
                assert counts[len(prefix.encode()) - 1] == tokens, prefix
                fits = len(prefix.encode()) if tokens <= 8 else fits
            assert r.fit_bytes == fits
    assert token_counts.count_tokens(empty, BYTE).count() == 0


def test_prefixes_of_odd_texts():
    c, t = token_counts.PrefixCounter(BYTE), Tokenizer.from_file(BYTE)
    for text in ["  \n\n  a  b\t\tc ", "it's we'rest 'll 'r", "naïve — 日本語 ’s 12３ ----------- =====", "a" * 70 + " " * 40 + " x"]:
        c.learn([text])
        counts = np.cumsum(c.text_increments(text), dtype=int)
        for n in range(1, len(text) + 1):
            assert counts[len(text[:n].encode()) - 1] == len(t.encode(text[:n], add_special_tokens=False).ids), text[:n]


def test_quality(spark, docs, empty):
    good = [(i, f"Plain sentence number {i} about the river, the hill and {'many ' * (i % 3)}other things.", "a") for i in range(400)]
    bad = [(1000 + i, "BUY!!! " * (20 + i % 7), "b") for i in range(80)]
    table = spark.createDataFrame(good + bad, SCHEMA)
    labels = spark.createDataFrame([(k, int(k < 1000), 0) for k, *_ in good + bad if k % 2] + [(None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in pu_quality.classify(table, labels).collect()}
    unseen = [r for r in out.values() if r.held_out]
    assert unseen and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out.values())
    assert np.mean([(r.predicted == 1) == (r.doc_id < 1000) for r in unseen]) > 0.95
    odd = pu_quality.classify(docs, labels).collect()
    assert len(odd) == len(ROWS) and all(r.score == 0 for r in odd if r.doc_id in (2, 3, 8))
    assert pu_quality.classify(docs, labels.limit(0)).where("score > 0").count() == len(ROWS) - 3
    assert pu_quality.classify(empty, labels).count() == 0


def test_html():
    page = """<!DOCTYPE html><head><title>t</title><script>if (a<b) "</p>";</script></head><body><nav><ul><li>Home<li>About</ul></nav>
    <!-- note --><div class="ad banner">Buy</div><article><h1>Big &amp; <i>bold</i>er</h1><p>One<br>two<p>three&nbsp; four
    <form>mail</form><div class="comments"><p>me too</p></div></article><footer>end</footer>"""
    assert html_template.main_text(page, frozenset()) == "Big & bolder One two three four"
    assert html_template.main_text(None, frozenset()) == html_template.main_text("", frozenset()) == ""
    assert html_template.main_text("<article><p>a < b", frozenset()) == "a < b"
    assert html_template.main_text("<nav>menu<article><p>x</p></article>", frozenset()) == "x"


def test_html_template(spark):
    page = "<body><div class=top>Our site</div><div class=body><p>Text {0} one.</p><p>Text {0} two.</p></div><p>All rights</p></body>"
    rows = [(i, "http://h.example/" + str(i), page.format(i)) for i in range(9)] + [(9, None, None), (10, "x", ""), (9, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))
    out = sorted((r.page_id, r.text, r.n_chars) for r in html_template.extract(df).collect())
    assert out == sorted([(i, f"Text {i} one. Text {i} two.", 23) for i in range(9)] + [(9, "", 0), (9, "", 0), (10, "", 0)])
    assert html_template.extract(df.limit(0)).count() == 0


def test_html_notice_in_article(spark):
    """Text of the template goes from articles too, whatever its class; also where one layout of many has it."""
    page = "<body><main class='{0}'><h1>Title {1}</h1><p class=x>House line of {0}.</p><p>Text {1}.</p></main></body>"
    rows = [(i, "http://h.example/", page.format("ab"[i % 2], i)) for i in range(14)]
    rows += [(20 + i, "http://copies.example/", "<body><article><p>All the same.</p></article></body>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r.text for r in html_template.extract(df).collect()}
    assert all(out[i] == f"Title {i} Text {i}." for i in range(14))
    assert all(out[20 + i] == "All the same." for i in range(6))  # no slot: the page is kept


def test_decontamination(spark, docs, empty):
    bench = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (2, "Apache LICENSE"), (3, None), (None, "one"), (4, ""),
                                   (2, "Apache LICENSE"), (5, "one")], "item_id long, text string")
    text = "x W1-w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 y apache license"
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(99, text)], "doc_id long, text string"))
    for chars in (8_000_000, 10):  # also with a block for every item
        out = {r.doc_id: r for r in wu_manber.find_leaks(more, bench, block_chars=chars).collect()}
        assert (out[99].n_words, out[99].n_hit, out[99].n_items) == (15, 13, 2)
        assert out[99].items_sha256 == hashlib.sha256(b"1,2").hexdigest()
        assert out[1].n_hit == 2 and out[4].n_hit == 1 and not out[2].contaminated and out[3].n_words == 0
    assert wu_manber.find_leaks(empty, bench).count() == 0
    assert wu_manber.find_leaks(docs, bench.limit(0)).where("contaminated").count() == 0


def test_decontamination_holds_one_block(spark, monkeypatch):
    """A pass per block: no block's tables are with the workers while the next one's are."""
    context, alive, most = type(spark.sparkContext), set(), []
    send, drop = context.broadcast, Broadcast.destroy

    def broadcast(self, value):
        out = send(self, value)
        alive.add(id(out))
        most.append(len(alive))
        return out

    monkeypatch.setattr(context, "broadcast", broadcast)
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: (alive.discard(id(self)), drop(self, *a))[1])
    bench = spark.createDataFrame([(i, f"x{i} y{i} z{i}") for i in range(4)], "item_id long, text string")
    rows = [(1, "a x0 y0 z0 x3 y3 z3 b x1 y1 z1"), (1, "a x0 y0 z0 x3 y3 z3 b x1 y1 z1"), (2, None), (None, "x2 y2 z2"), (3, "x2 y2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = wu_manber.find_leaks(docs, bench, block_chars=8, extra=("text",)).collect()
    assert len(most) == 4 and max(most) == 1
    assert sorted(repr((r.doc_id, r.n_hit, r.n_items, [tuple(s) for s in r.spans], r.text)) for r in out) == sorted(map(repr, [
        (1, 9, 3, [(1, 7), (8, 11)], rows[0][1])] * 2 + [(2, 0, 0, [], None), (None, 3, 1, [(0, 3)], "x2 y2 z2"), (3, 0, 0, [], "x2 y2")]))


def near_classes(rows, k):
    def shingles(t):
        w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    sets = {i: shingles(t) for i, t in rows}
    part = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = part[a], part[b]
                part = {i: min(x, y) if p in (x, y) else p for i, p in part.items()}
    return {i: (len(sets[i]), part[i]) for i in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, docs, empty, k):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 300, 60))) for i in range(40)]
    for i in range(60):  # copies of a few originals, edited in up to six words
        words = rows[i % 5][1].split()
        for at in rng.integers(0, 60, i % 7):
            words[at] = f"e{rng.integers(0, 50)}"
        rows.append((100 + i, " ".join(words)))
    rows += [(300, None), (301, ""), (302, "Solo"), (303, "solo"), (304, " ")]
    got = fss_neardup.link(spark.createDataFrame(rows, "doc_id long, text string"), k=k).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_classes(rows, k)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    odd = fss_neardup.link(docs, k=k).collect()
    assert len(odd) == len(ROWS) and {r.component_id for r in odd if r.doc_id in (4, 7)} == {4}
    assert [r.kept for r in odd if r.doc_id is None] == [True]
    assert fss_neardup.link(empty, k=k).count() == 0


def test_near_dedup_rows(spark, empty):
    """Rows are counted, not ids: repeated rows, null ids and two texts under one id."""
    a, b, c = ("".join(f"{x}{i} " for i in range(30)) for x in "abc")
    rows = [(4, "one")] * 5 + [(5, a)] * 3 + [(6, a), (None, a), (None, b), (None, b), (None, b + "end"), (7, c), (7, a)]
    rows += [(8, None)] * 2 + [(9, ""), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.char_length("text").cast("long").alias("n_chars"))
    out = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, SF0001).collect()]
    noid = [t for i, t in out if i is None]
    assert len(noid) == 2 and None in noid and {b, b + "end"} & set(noid)
    assert collections.Counter(r for r in out if r[0] is not None) == \
        collections.Counter([(4, "one"), (5, a), (7, c), (8, None), (9, "")])


def test_sketch_estimates_similarity():
    a = np.unique(fss_neardup.mix(np.arange(1, 900, dtype=np.uint64)))
    b = np.unique(fss_neardup.mix(np.arange(101, 1000, dtype=np.uint64)))
    alike = (fss_neardup.sketch(a, 1024) == fss_neardup.sketch(b, 1024)).mean()
    assert abs(alike - 799 / 999) < 0.06
    assert (fss_neardup.sketch(a[:1], 64) != np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def test_pipeline(spark, docs, empty):
    table = spark.read.parquet(f"{SF0001}/documents.parquet")
    seen = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, SF0001).cache()
        assert out.columns == list(corpus_pipeline.COLUMNS) and 0 < out.count() <= seen.count()
        before = {r.doc_id for r in seen.select("doc_id").collect()}
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        assert kept <= before
        if name == "near_dedup":
            found = near_classes([(r.doc_id, r.text) for r in seen.collect()], 5)
            assert kept == {i for i, (_, c) in found.items() if i == c}
        if name == "decontaminate":
            left = wu_manber.find_leaks(out, spark.read.parquet(f"{SF0001}/benchmark.parquet"))
            assert left.where("contaminated").count() == 0 and len(before - kept) < 0.2 * len(before)
        seen = out
    packed = corpus_pipeline.STAGES[-1][1](spark, seen, SF0001)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in seen.collect()}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF0001).count() == 0
        assert stage(spark, docs.select(*corpus_pipeline.COLUMNS, "k", "pos", "score"), SF0001).count() >= 0
    assert corpus_pipeline.run(spark, SF0001).count() > 0


def test_line_spread_of_long_texts(spark):
    """Tens of thousands of spread lines in one text cost no more than its lines."""
    lines = [f"shared line {i}" for i in range(40000)]
    rows = [(i, "\n".join(lines) + f"\nown {i}", f"s{i}") for i in range(6)]
    out = {r.doc_id: (r.n_removed, r.text) for r in line_spread.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[0] == (0, rows[0][1]) and all(out[i] == (40000, f"own {i}") for i in range(1, 6))


def test_boilerplate_pairs_nobody(spark, monkeypatch):
    """Documents of one frame at similarity 0.65 never meet; near copies among them are all found."""
    pick = random.Random(4)
    frame = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        own = [f"o{i}x{j}" for j in range(15)]
        rows.append((i, " ".join(frame + own), "s"))
        if i % 3 == 0:  # one word of the own part changed: similarity above 0.8
            own[pick.randrange(13, 15)] = "other"
            rows.append((1000 + i, " ".join(frame + own), "s"))
    met = []
    plain = fss_neardup.rare_prefixes
    monkeypatch.setattr(fss_neardup, "rare_prefixes", lambda *a: met.append(plain(*a)) or met[0])
    out = {r.doc_id: r.component_id for r in fss_neardup.link(spark.createDataFrame(rows, SCHEMA)).collect()}
    sets = {r[0]: set(fss_neardup.shingle_set(r[1], 5).tolist()) for r in rows}
    want = {d: d for d in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((want[a], want[b]))
            want = {d: low if c == high else c for d, c in want.items()}
    assert out == want and sum(d != c for d, c in want.items()) == 50
    buckets = collections.Counter(r.key for r in met[0].select("key").collect())
    assert sum(n * n for n in buckets.values()) < 20 * len(rows)
