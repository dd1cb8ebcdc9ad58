"""Searches that send one side in blocks and stream the other, and TF-IDF within the row (findings of round 4)."""
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomtext import session as SS
from loomtext.operators import cells as CL
from loomtext.operators import models as M
from loomtext.operators import retrieval as RT
from loomtext.operators import rowvectors as RV
from loomtext.operators import sparsetiles as ST
from loomtext.operators import vectors as V

VEC = "id long, v array<double>"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _vectors(spark, n, d, seed):
    m = np.random.default_rng(seed).normal(size=(n, d))
    m[n // 2] = m[n // 2 + 1]
    return m, spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], VEC).repartition(3)


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_dense_searches_over_many_blocks(spark, monkeypatch, block):
    """Best, near and counted candidates when cells are spread over blocks; no vector is repeated for a cell."""
    monkeypatch.setattr(CL, "BLOCK", block)
    m, df = _vectors(spark, 240, 4, 3)
    s = np.round(m @ m.T, 6)
    cells = CL.Cells(df, "id", "v", 60)
    assert (len(cells.blocks()) > 5) == (block == 64)
    top = V.dense_topk(df, "id", "v", df, "id", "v", 5, exclude_self=True, tile_q=50, cells=cells)
    got = {(r.qid, r["rank"]): (r.cid, r.score) for r in top.collect()}
    for i in range(240):
        order = sorted((j for j in range(240) if j != i), key=lambda j: (-s[i, j], j))[:5]
        assert [got[i, k + 1] for k in range(5)] == [(j, s[i, j]) for j in order]
    pairs = V.dense_pairs(df, "id", "v", df, "id", "v", 2.0, exclude_self=True, tile_q=50, tile_c=60)
    assert {(r.qid, r.cid) for r in pairs.collect()} == {(i, j) for i, j in zip(*np.nonzero(s >= 2.0)) if i != j}
    for plan in (_plan(top), _plan(pairs)):
        assert "CoGroup" not in plan and "Generate explode" not in plan


def _sparse(spark, n, seed):
    rng = np.random.default_rng(seed)
    w = np.zeros((n, 60))
    for i in range(n):
        w[i, rng.choice(60, rng.integers(1, 9), replace=False)] = rng.uniform(0.1, 1)
        w[i] /= np.linalg.norm(w[i])
    vec = rng.normal(size=(n, 3))
    rows = [(i, vec[i].tolist(), np.flatnonzero(w[i]).tolist(), w[i][w[i] > 0].tolist()) for i in range(n)]
    return w, vec, spark.createDataFrame(rows, "id long, vec array<double>, idx array<int>, weight array<double>").repartition(3)


def test_sparse_candidates_are_read_once(spark, monkeypatch):
    """No candidate is shuffled, and a query has a row of each task, not of each pair of tiles."""
    monkeypatch.setattr(ST, "ENTRIES", 100)  # several blocks
    w, vec, df = _sparse(spark, 150, 4)
    q, c = df.where("id < 40"), df.where("id >= 30")
    met = ST.sparse_best(q, c, 3, 1.0, tile=10)
    assert "Exchange" not in _plan(met).replace("RoundRobinPartitioning(3)", "").replace("Exchange , REPARTITION", "") and "CoGroup" not in _plan(met)
    rows = met.collect()
    assert len(rows) <= 40 * 3
    s, rel = np.round(w @ w.T, 6), np.round(vec @ vec.T, 6) >= 1.0
    assert {i: sum(r.n_relevant for r in rows if r.qid == i) for i in range(40)} == {i: int(rel[i, 30:].sum()) for i in range(40)}
    pairs = ST.sparse_best_pairs(q, c, 3, True, tile=10).collect()
    for i in range(40):
        own = sorted((-r.score, r.cid) for r in pairs if r.qid == i)[:3]
        assert own == sorted((-s[i, j], j) for j in range(30, 150) if j != i and s[i, j] > 0)[:3]


def test_ranks_known_from_the_best_are_not_counted_again(spark, monkeypatch):
    w, vec, df = _sparse(spark, 90, 7)
    own = df.select("id", F.col("vec").alias("full"))
    q, bank, weights = own.where("id < 30"), own.where("id >= 30"), df.select("id", "idx", "weight")
    counted = []
    for name in ("sparse_rank_of", "dense_rank_of"):
        monkeypatch.setattr(RT, name, lambda a, *x, f=getattr(RT, name), **y: counted.append(a.count()) or f(a, *x, **y))
    sparse = {r.qid: r for r in RT.per_query_metrics_sparse(q, bank, "id", "full", weights, 1.0).collect()}
    dense = {r.qid: r for r in RT.per_query_metrics(q, bank, "id", "full", "full", 1.0).collect()}
    rel = np.round(vec @ vec.T, 6) >= 1.0
    for got, s in ((sparse, np.round(w @ w.T, 6)), (dense, np.round(vec @ vec.T, 6))):
        for i in range(30):
            order = sorted(range(30, 90), key=lambda j: (-s[i, j], j))
            ranks = [n + 1 for n, j in enumerate(order) if rel[i, j]]
            assert got[i].n_relevant == len(ranks) and got[i].rr == (1 / ranks[0] if ranks else 0.0)
    assert 0 < counted[1 - 1] < 25 and counted[1] == 0  # dense: relevance and rank go by the same vector


def test_counting_needs_little_more_than_the_words():
    """One number for a word and its row: the step of a task that held most."""
    rng = np.random.default_rng(1)
    words = pa.array([f"w{i}" for i in range(3000)])
    n = 400_000
    units = pa.ListArray.from_arrays(pa.array(np.arange(0, n + 1, 400), pa.int32()), words.take(pa.array(rng.zipf(1.2, n) % 3000)))
    tracemalloc.start()
    RV.gram_counts(units, True, 10_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * n


def test_batches_are_bounded_unless_set(spark):
    key, size = SS.BATCH_BYTES
    spark.conf.unset(key)
    SS.bound_batches(spark)
    assert spark.conf.get(key) == size
    spark.conf.set(key, "1m")
    SS.bound_batches(spark)
    assert spark.conf.get(key) == "1m"
    spark.conf.set(key, size)


TEXTS = ["red fox and red hen", "fox hen owl", "owl owl red", "", None, "hen fox fox owl", "blue"]


def test_fitted_words_are_not_kept_by_the_executors(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    V.fit_tfidf(docs, "id", "text", 1, 1.0, 50)[1].count()
    V.text_vocabulary(docs, "id", "text", 1, 1.0, 50).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_top_features_of_rows_match_those_of_long_tables(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    model, long = V.fit_tfidf(docs, "id", "text", 1, 1.0, 50)
    rows = model.vectors(docs, "id", "text")
    terms = [t for t in model.rows.terms if t != "hen"]  # a term without a coefficient has no row
    coefs = spark.createDataFrame([(t, c, ((len(t) + c) % 3 - 1) / 7) for t in terms for c in range(2)], "term string, cls int, coef double")
    key = lambda df: sorted((r.id, r.term, r.contribution, r["rank"]) for r in df.collect())
    one = coefs.where("cls = 0").select("term", "coef")
    for positive in (False, True):
        got = M.top_features(rows, one, 3, positive, model.rows)
        assert key(got) == key(M.top_features(long, one, 3, positive)) and "Exchange" not in _plan(got)
    cls = docs.select("id", (F.col("id") % 3).cast("int").alias("cls"))  # class 2: the model has none
    want = key(M.top_features_of_class(long, coefs, cls, 3))
    assert key(M.top_features_of_class(rows, coefs, cls, 3, model.rows)) == want
    got = M.top_features_of_class(rows.withColumn("c", (F.col("id") % 3).cast("int")), coefs, "c", 3, model.rows)
    assert key(got) == want and want and "Exchange" not in _plan(got)


def test_scoring_and_ranking_take_one_worker_a_task(spark):
    """Weighing, scoring and ranking run in one Python step, with the results of steps one after another."""
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    model, units = V.fit_tfidf_units(docs, "id", "text", 1, 1.0, 50)
    m = model.rows
    coef = np.random.default_rng(2).normal(size=(3, len(m.terms)))
    rows, weighed = m.vectors(units, "units", ["id"]), m.weighed(units, "units", ["id"])
    key = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    assert key(RV.margins(weighed, ["id"], coef, [0.1, 0.2, 0.3])) == key(RV.margins(rows, ["id"], coef, [0.1, 0.2, 0.3]))
    rounded = F.transform("margins", lambda x: F.round(x, 9))
    cls = (F.array_position(rounded, F.array_max(rounded)) - 1).cast("int").alias("cls")
    scored = RV.margins(rows, ["id", "idx", "weight"], coef, [0.0] * 3).select("id", "idx", "weight", cls)
    want = RV.top_features_rows(scored, ["id", "cls"], m, coef, 4, cls="cls")
    got = RV.top_features_rows(weighed.with_class("cls", coef, [0.0] * 3), ["id", "cls"], m, coef, 4, cls="cls")
    assert key(got) == key(want) and _plan(got).count("MapInArrow") == 1


def test_contractions_within_parts_are_those_of_the_text(spark):
    """No rule reaches over a space: parts with an apostrophe alone give what the whole text gives."""
    from loomtext.functions import fixed as X
    from loomtext.functions import text as TX
    texts = ["I'm sure it's fine,don't  worry", " can't", "won't ", "the'd\tyou’ll\nY'all're they'd've", "x n't 'n't a'int ain't", "'", "’ ’", "", None,
             "let's  go  what's-this it'sx shan't_ you've,we've", "no apostrophe  here ", "rock'n'roll isn't aren't you're"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    whole = F.col("t")
    for pattern, to in X.CONTRACTIONS:
        whole = F.regexp_replace(whole, pattern, to)
    rows = df.select("t", TX.expand_contractions("t").alias("got"), whole.alias("want")).collect()
    assert all(r.got == r.want for r in rows) and sum(r.t != r.got for r in rows) >= 6


def test_three_cleaners_share_their_first_steps(spark):
    import __spark_entry__ as E
    from conftest import SF0001
    from loomtext.functions import text as TX
    full = E.queries()["clean_full"](spark, SF0001)
    assert full._jdf.queryExecution().optimizedPlan().toString().count("reflect(") == 1
    df = spark.createDataFrame([(t,) for t in ["It's #fun @you  1234 😀!!!", " ", None, "mail a@b.co 12 http://x.y Don't"]], "t string").withColumn("s", TX.clean_shared("t"))
    for f in TX.CLEANERS.values():
        assert [r[0] for r in df.select(f("t")).collect()] == [r[0] for r in df.select(f("t", shared="s")).collect()]
