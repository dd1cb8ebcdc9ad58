"""Term counts inside the tasks, the vocabulary by bounds, recommendations in tiles (findings F7, F14, F15, F22)."""
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomtext.operators import rowvectors as RV
from loomtext.operators import sparsetiles as ST
from loomtext.operators import vectors as V


def _rows(n=300, seed=5):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    rows = [[rnd.choice(words[:rnd.choice([3, 12, 40])]) for _ in range(rnd.randrange(0, 25))] for _ in range(n)]
    return rows + [None, [], ["w1"]]


def _grams(u):
    return (u or []) + [f"{a} {b}" for a, b in zip(u or [], (u or [])[1:])]


def _want(rows):
    tf = [Counter(_grams(u)) for u in rows]
    cf = sum(tf, Counter())
    return {t: (sum(t in c for c in tf), n) for t, n in cf.items()}


def _table(spark, rows, parts=4):
    return spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "id long, units array<string>").repartition(parts)


def _stats(df):
    return {r.term: (r.df, r.cf) for r in df.collect()}


def test_counts_of_rows_also_of_words_with_spaces():
    for rows in (_rows(), [["a b", "c", "a", "b", "a b"], ["a", "b c"], ["a b", "c"], []], [[None, "a", None, "a", "a"], ["a"]]):
        clean = [[w for w in u or [] if w is not None] for u in rows]
        want = _want(clean) if all(None not in (u or []) for u in rows) else {"a": (2, 4), "a a": (1, 1)}
        terms, df, cf, least = RV.gram_counts(pa.array(rows, pa.list_(pa.string())), True)
        assert least == 0 and len(set(terms.to_pylist())) == len(terms)
        assert dict(zip(terms.to_pylist(), zip(df.tolist(), cf.tolist()))) == want
    rows = [["a b", "c", "a", "b", "a b"], ["a", "b c"], ["a b", "c"]]
    want = _want(rows)
    known = RV.Known(pa.array(sorted(want)))
    row, idx, tf = RV.row_counts(pa.array(rows), known, True)
    got = Counter()
    for r, i, n in zip(row, idx, tf):
        got[r, known.terms[i].as_py()] = n
    assert got == Counter({(r, t): n for r, u in enumerate(rows) for t, n in Counter(_grams(u)).items()})


def test_most_frequent_of_rows_bound_the_others():
    rows = _rows()
    want = _want(rows)
    for most in (1, 7, 50):
        terms, df, cf, least = RV.gram_counts(pa.array(rows, pa.list_(pa.string())), True, most)
        assert len(terms) <= most and least > 0
        assert {t: (d, c) for t, d, c in zip(terms.to_pylist(), df, cf)} == {t: x for t, x in want.items() if x[1] > least}


@pytest.mark.parametrize("most", [8, 30, 120, 100_000])
def test_vocabulary_by_bounds_is_the_vocabulary(spark, monkeypatch, most):
    """Whatever the parts leave out, the capped vocabulary is that of whole counts."""
    rows = _rows()
    whole = _stats(V.vocabulary_of(RV.term_stats(_table(spark, rows), "units"), len(rows), 2, 0.3, 20))
    kept = sorted(((t, x) for t, x in _want(rows).items() if 2 <= x[0] <= 0.3 * len(rows)), key=lambda p: (-p[1][1], p[0]))[:20]
    assert whole == dict(kept)
    sent, counted = [], []
    monkeypatch.setattr(RV, "counts_of", lambda df, u, t, b, f=RV.counts_of: counted.append(len(t)) or f(df, u, t, b))
    found = RV.frequent_terms(_table(spark, rows), "units", len(rows), 20, 2, 0.3, most=most)
    assert _stats(V.vocabulary_of(found, len(rows), 2, 0.3, 20)) == whole
    if most == 120:
        assert counted and counted[0] < len(_want(rows))


def test_text_vocabulary_counts_rows_of_an_id_once(spark):
    docs = spark.createDataFrame([(1, "red fox red fox"), (1, "red dog"), (2, "red fox"), (3, None), (None, "fox"), (None, "fox")], "id long, text string")
    for df in (docs, docs.where("id > 1")):
        want = V.build_vocabulary(V.term_counts(df, "id", "text"), df.count(), 1, 1.0, 5)
        assert _stats(V.text_vocabulary(df, "id", "text", 1, 1.0, 5)) == _stats(want)
    plan = V.text_vocabulary(docs.where("id > 1"), "id", "text", 1, 1.0, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan


@pytest.mark.parametrize("exclude", [False, True])
def test_recommendations_in_tiles_match_those_of_long_tables(spark, exclude, monkeypatch):
    rows = _rows(120)
    t = _table(spark, rows)
    model = RV.fit_terms(t, "units", len(rows), 60, 2, 0.9)
    vec, long = model.vectors(t, "units", ["id"]), model.long(t, "units", ["id"]).cache()
    some = F.col("id") % 3 == 0
    ids = t.select("id")
    q = (ids.where(some), "id")
    want = V.sparse_topk(long.where(some), long, 4, exclude, q, (ids, "id"))
    key = lambda df: {(r.qid, r["rank"]): (r.cid, round(r.score, 6)) for r in df.collect()}
    monkeypatch.setattr(ST, "TILE", 64)
    assert key(V.sparse_topk(vec.where(some), vec, 4, exclude, q, (ids, "id"))) == key(want)
    pairs = ST.sparse_best_pairs(vec.where(some), vec, 4, exclude, (41, 123), tile=25)
    assert pairs.groupBy("qid").count().agg(F.max("count")).first()[0] <= 4 * 5  # k of a tile, not all that share a term
    none = vec.where("id < 0")
    assert V.sparse_topk(none, vec, 3).count() == 0 and V.sparse_topk(vec, none, 3).count() == 0


def test_norm_of_a_vector_is_computed_once(spark):
    """Not anew for every element: the lambda that divides holds no sum."""
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([],), (None,), ([1.0, None],)], "v array<float>").select(V.l2_normalize("v").alias("n"))
    assert [r.n for r in df.collect()] == [[0.6, 0.8], [0.0, 0.0], [], None, [1.0, None]]
    plan = df._jdf.queryExecution().analyzed().toString()
    divides = [part for part in plan.split("lambdafunction(")[1:] if "/" in part.split(", lambda")[0]]
    assert divides and all("aggregate" not in part.split(", lambda")[0] for part in divides)
