"""Pruned top-k, sparse and dense, against brute force; how much the bounds leave out."""
import numpy as np
import pytest
from loomtext.operators import topk as TP
from loomtext.operators import vectors as V
from loomtext.operators.cells import Cells

VEC = "id long, v array<double>"


def _table(spark, m, start=0):
    return spark.createDataFrame([(start + i, x.tolist()) for i, x in enumerate(m)], VEC)


def _clustered(n, centres, d, seed, spread=0.02):
    rng = np.random.default_rng(seed)
    c = np.random.default_rng(99).normal(size=(centres, d))
    m = c[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, d))
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _brute(q, c, k, qstart=0, exclude=False):
    s = np.round(q @ c.T, 6)
    out = {}
    for i in range(len(q)):
        js = [j for j in sorted(range(len(c)), key=lambda j: (-s[i, j], j)) if not (exclude and j == i + qstart)][:k]
        out[i + qstart] = [(j, s[i, j]) for j in js]
    return out


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.qid, r["rank"])):
        out.setdefault(r.qid, []).append((r.cid, r.score))
    return out


def test_dense_clusters_are_skipped(spark):
    c = _clustered(1500, 20, 16, 1)
    cdf = _table(spark, c)
    cells = Cells(cdf, "id", "v", 100)
    got = _found(V.dense_topk(cdf, "id", "v", cdf, "id", "v", 4, exclude_self=True, tile_q=60, tile_c=100, cells=cells))
    want = _brute(c, c, 4, exclude=True)
    assert {q: [j for j, _ in r] for q, r in got.items()} == {q: [j for j, _ in r] for q, r in want.items()}
    assert cells.count.sum() == 1500
    assert cells.met < 0.35 * 1500 * 1500  # of all pairs


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_any_norm_zero_and_null(spark, seed):
    """Vectors of any length, negative products, zero vectors, ties by id, rows without a vector."""
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(300, 5)) * rng.uniform(0, 3, size=(300, 1))
    c[::17] = 0.0
    c[50:60] = c[40:50]
    q = np.vstack([rng.normal(size=(20, 5)), np.zeros((1, 5)), -c[41:42]])
    cdf = _table(spark, c).unionByName(spark.createDataFrame([(900, None), (None, [1.0] * 5)], VEC))
    qdf = _table(spark, q)
    got, want = _found(V.dense_topk(qdf, "id", "v", cdf, "id", "v", 6, tile_q=5, tile_c=40)), _brute(q, c, 6)
    assert {a: [j for j, _ in r] for a, r in got.items()} == {a: [j for j, _ in r] for a, r in want.items()}
    s = np.round(q @ c.T, 6)
    for least in (0.5, 0.0, -0.2):
        pairs = {(r.qid, r.cid) for r in V.dense_pairs(qdf, "id", "v", cdf, "id", "v", least, tile_q=5, tile_c=40).collect()}
        assert pairs == {(int(a), int(b)) for a, b in zip(*np.nonzero(s >= least))}
    star = [(i, q[i].tolist(), float(s[i, 33]), 33) for i in range(len(q))]
    sdf = spark.createDataFrame(star, "id long, v array<double>, s double, c long")
    ahead = {r.qid: r.n_before for r in V.dense_rank_of(sdf, "id", "v", "s", "c", cdf, "id", "v", tile_q=5, tile_c=40).collect()}
    assert ahead == {i: sum((s[i, j], -j) > (s[i, 33], -33) for j in range(300)) for i in range(len(q))}


def test_dense_empty_and_few(spark):
    q, none = _table(spark, np.eye(3)), spark.createDataFrame([], VEC)
    assert V.dense_topk(q, "id", "v", none, "id", "v", 2).count() == 0
    assert V.dense_topk(none, "id", "v", q, "id", "v", 2).count() == 0
    assert V.dense_pairs(q, "id", "v", none, "id", "v", 0.1).count() == 0
    assert V.dense_topk(q, "id", "v", q, "id", "v", 9).count() == 9  # fewer candidates than k: all
    star = spark.createDataFrame([(1, [1.0], 0.5, 3)], "id long, v array<double>, s double, c long")
    assert [tuple(r) for r in V.dense_rank_of(star, "id", "v", "s", "c", none, "id", "v").collect()] == [(1, 0)]


def _weights(n, seed, common=3, vocab=400):
    """Documents of ``common`` words that all have and ten of a Zipf vocabulary, weighted by idf, of unit length."""
    rng = np.random.default_rng(seed)
    docs = [sorted({f"c{i}" for i in range(common)} | {f"w{int(x) % vocab}" for x in rng.zipf(1.3, 10)}) for _ in range(n)]
    df = {}
    for d in docs:
        for t in d:
            df[t] = df.get(t, 0) + 1
    rows = []
    for i, d in enumerate(docs):
        w = np.array([np.log((1 + n) / (1 + df[t])) + 0.05 for t in d]) * rng.uniform(0.8, 1.2, len(d))
        w /= np.linalg.norm(w)
        rows += [(i, t, float(x)) for t, x in zip(d, w)]
    return rows


@pytest.mark.parametrize("broadcast_rows", [2_000_000, 10])
def test_sparse_reads_what_the_bounds_leave(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(TP, "BROADCAST_ROWS", broadcast_rows)  # 10: both sides salted
    rows = _weights(400, 3)
    w = spark.createDataFrame(rows, "id long, term string, weight double")
    q = w.where("id < 40")
    pairs = TP.pruned_pairs(q, w, 5, exclude_self=True)
    vec = {}
    for i, t, x in rows:
        vec.setdefault(i, {})[t] = x
    score = {(a, b): sum(x * vec[b].get(t, 0.0) for t, x in vec[a].items()) for a in range(40) for b in vec if a != b}
    kept = pairs.collect()
    assert len(kept) == len({(r.qid, r.cid) for r in kept})
    assert all(abs(r.score - score[r.qid, r.cid]) < 1e-9 for r in kept)  # whole scores
    every = V.cosine_sparse(q, w, True).count()
    assert every == 40 * 399 and len(kept) < every / 4  # all share the common words
    got = _found(V.sparse_topk(q, w, 5, exclude_self=True))
    for a in range(40):
        s = {b: round(score[a, b], 6) for b in vec if b != a}
        assert [c for c, _ in got[a]] == [b for b in sorted(s, key=lambda b: (-s[b], b)) if s[b] > 0][:5]


def test_sparse_ties_few_and_empty(spark):
    schema = "id long, term string, weight double"
    w = spark.createDataFrame([(i, "a", 1.0) for i in range(6)] + [(9, "z", 1.0)], schema)
    got = _found(V.sparse_topk(w, w, 3, exclude_self=True))
    assert [c for c, _ in got[0]] == [1, 2, 3] and [c for c, _ in got[5]] == [0, 1, 2] and 9 not in got
    none = spark.createDataFrame([], schema)
    assert V.sparse_topk(none, w, 3).count() == 0 and V.sparse_topk(w, none, 3).count() == 0


def test_dense_candidates_are_sent_once_per_query_tile(spark):
    """Unclustered vectors: every query visits every cell, and yet a candidate meets each tile of queries once."""
    import pandas as pd
    from pyspark.sql import functions as F
    m = np.random.default_rng(5).normal(size=(600, 8))
    df = _table(spark, m)
    cells = Cells(df, "id", "v", 100)
    q = df.select("id", F.col("v").alias("vec")).withColumn("cells", cells.within("vec", F.lit(-1e9)))
    sent = cells.search(q, 10_000, lambda a, b: pd.DataFrame({"n_q": [len(a)], "n_c": [len(b)]}), "n_q long, n_c long").collect()
    assert len(cells.pivots) > 10 and sum(r.n_c for r in sent) == 600
    assert cells.met == sum(r.n_q * r.n_c for r in sent)


def test_dense_best_counts_in_tiles(spark):
    """The number of relevant candidates and the best of them by another vector, against brute force."""
    rng = np.random.default_rng(6)
    rel, rank = rng.normal(size=(200, 4)), rng.normal(size=(200, 6))
    rank[30:40] = rank[20:30]
    df = spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(rel, rank))], "id long, a array<double>, b array<double>")
    q = df.where("id < 40")
    got = {r.qid: (r.n_relevant, r.s_star, r.c_star) for r in V.dense_best(q, "id", "a", "b", df, "id", 3.0, tile_q=7, tile_c=30).collect()}
    s, r = np.round(rank @ rank.T, 6), np.round(rel @ rel.T, 6)
    want = {}
    for i in range(40):
        js = [j for j in range(200) if r[i, j] >= 3.0]
        if js:
            best = min(js, key=lambda j: (-s[i, j], j))
            want[i] = (len(js), s[i, best], best)
    assert got == want and len(want) > 5


def test_sparse_tiles_rank_all_candidates(spark):
    """Best, relevant and preceding candidates by sparse weights over many tiles, against brute force."""
    from loomtext.operators import sparsetiles as ST
    rng = np.random.default_rng(8)
    n, terms = 150, 200
    w = np.zeros((n, terms))
    for i in range(n):
        w[i, rng.choice(terms, rng.integers(1, 12), replace=False)] = 1.0
        w[i, :2] = rng.uniform(0.1, 1, 2)  # terms that all have: columns of the matrix
        w[i] /= np.linalg.norm(w[i])
    w[40], w[41] = 0.0, w[42]
    vec = rng.normal(size=(n, 3))
    rows = [(i, vec[i].tolist(), None if i == 40 else np.flatnonzero(w[i]).tolist(), None if i == 40 else w[i][w[i] > 0].tolist()) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, idx array<int>, weight array<double>")
    q, c = df.where("id < 50"), df.where("id >= 35")
    s, rel = np.round(w @ w.T, 6), np.round(vec @ vec.T, 6) >= 2.0
    met = ST.sparse_best(q, c, 4, 2.0, tile=20)
    got = {}
    for r in met.collect():
        g = got.setdefault(r.qid, [0, [], []])
        g[0] += r.n_relevant
        g[1] += [(-r.s_star, r.c_star)] * (r.n_relevant > 0)
        g[2] += [(-x.score, x.cid) for x in r.top]
    assert sorted(got) == list(range(50))
    star = []
    for i in range(50):
        order = sorted(range(35, n), key=lambda j: (-s[i, j], j))
        own = [j for j in order if rel[i, j]]
        assert got[i][0] == len(own)
        assert [j for _, j in sorted(got[i][2])[:4]] == order[:4]
        if own:
            assert min(got[i][1]) == (-s[i, own[0]], own[0])
            star.append((i, float(s[i, own[0]]), own[0], order.index(own[0])))
    sdf = spark.createDataFrame(star, "id long, s_star double, c_star long, place long")
    ahead = {r.qid: r.n_before for r in ST.sparse_rank_of(q.join(sdf.drop("place"), "id"), c, tile=20).collect()}
    assert ahead == {i: p for i, _, _, p in star}
