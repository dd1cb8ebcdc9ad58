"""Row-wise TF-IDF and linear training against brute force."""
import math
from collections import Counter

import numpy as np
import pytest
from conftest import SF0001
from pyspark.sql import functions as F

from loomtext.functions import tokens as TK
from loomtext.operators import linear as L
from loomtext.operators import rowvectors as RV
from loomtext.operators import vectors as V

TEXTS = ["red fox runs", "red fox red fox", "", None, "blue whale sings blue songs", "fox sings", "unknown words only once",
         "red whale " * 300, "blue blue blue", "red fox runs"]


def _docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").repartition(3)


def _brute(min_df=2):
    def grams(t):
        u = (t or "").lower().split()
        return u + [f"{a} {b}" for a, b in zip(u, u[1:])]
    tf = [Counter(grams(t)) for t in TEXTS]
    df = Counter(g for c in tf for g in c)
    idf = {g: math.log((1 + len(TEXTS)) / (1 + n)) + 1 for g, n in df.items() if n >= min_df}
    out = {}
    for i, c in enumerate(tf):
        w = {g: (1 + math.log(n)) * idf[g] for g, n in c.items() if g in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.update({(i, g): x / norm for g, x in w.items()})
    return idf, out


def test_row_tfidf_matches_brute_force(spark):
    idf, want = _brute()
    model, w = V.fit_tfidf(_docs(spark), "id", "text", min_df=2, max_features=1000)
    assert dict(zip(model.rows.terms, model.rows.idf)) == pytest.approx(idf)
    assert {(r.id, r.term): r.weight for r in w.collect()} == pytest.approx(want)
    again = model.transform(_docs(spark), "id", "text")
    assert {(r.id, r.term): r.weight for r in again.collect()} == pytest.approx(want)
    stats = {r.term: (r.df, r.cf) for r in RV.term_stats(_docs(spark), TK.terms("text")).collect()}
    assert stats["red"] == (4, 304) and stats["red fox"] == (3, 4) and stats["blue"] == (2, 5)
    joined, jw = V.fit_tfidf(_docs(spark), "id", "text", min_df=2)  # no cap: joins
    assert {(r.id, r.term): r.weight for r in jw.collect()} == pytest.approx(want)


def test_rows_without_terms_stay_and_empty_tables(spark):
    model, _ = V.fit_tfidf(_docs(spark), "id", "text", min_df=2, max_features=1000)
    vec = model.rows.vectors(_docs(spark).withColumn("idx", F.lit("clash")), TK.terms("text"), ["id"])
    rows = {r.id: (r.idx, r.weight) for r in vec.collect()}
    assert len(rows) == len(TEXTS) and rows[2] == rows[3] == rows[6] == ([], [])
    coef = np.array([[0.5 if t == "red" else -0.25 for t in model.rows.terms]])
    scored = {r.id: r for r in RV.score_binary_rows(vec, ["id"], coef, 0.3).collect()}
    assert scored[3].prob == pytest.approx(1 / (1 + math.exp(-0.3))) and scored[3].pred == 1
    top = RV.top_features_rows(vec, ["id"], model.rows, coef, n=2).where("id = 1").orderBy("rank").collect()
    assert [(r.term, r["rank"]) for r in top] == [("red", 1), (min("fox", "fox red", "red fox", key=lambda t: (round(
        _brute()[1].get((1, t), 9) * 0.25, 9), t)), 2)]
    none = _docs(spark).limit(0)
    empty, w = V.fit_tfidf(none, "id", "text", max_features=10)
    assert w.count() == 0 and empty.rows.terms == []
    assert empty.transform(_docs(spark), "id", "text").count() == 0


def _data(classes, n=120, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * (rng.random((n, 4)) < 0.7)
    y = np.argmax(x[:, :classes] + rng.normal(scale=0.7, size=(n, classes)), axis=1)
    return x, y


def _frame(spark, x, y, names):
    rows = [([int(j) for j in np.flatnonzero(v)], [float(z) for z in v[np.flatnonzero(v)]], names[c]) for v, c in zip(x, y)]
    return spark.createDataFrame(rows + [([0], [1.0], None)], "idx array<int>, weight array<double>, y string").repartition(5)


def _descend(objective, shape, steps=20000):
    """Plain gradient descent with backtracking on a dense objective."""
    p, step = np.zeros(shape), 1.0
    v, g = objective(p)
    for _ in range(steps):
        while True:
            q = p - step * g
            nv, ng = objective(q)
            if nv <= v - 0.5 * step * (g * g).sum():
                break
            step /= 2
            if step < 1e-15:
                return p
        p, v, g, step = q, nv, ng, step * 1.5
        if np.abs(g).max() < 1e-9:
            break
    return p


@pytest.mark.parametrize("classes,loss", [(2, "log"), (3, "log"), (2, "hinge"), (3, "hinge")])
def test_training_reaches_the_brute_force_optimum(spark, classes, loss):
    x, y = _data(classes)
    names = "abc"[:classes]
    fit = L.fit_logistic if loss == "log" else L.fit_squared_hinge
    m = fit(_frame(spark, x, y, names), "y", 4, C=2.0, tol=1e-8)
    assert m.converged and m.classes == list(names)
    cw = len(y) / (classes * np.bincount(y))
    total, k = cw[y].sum(), 1 if classes == 2 else classes

    def objective(p):
        z = x @ p[:, :4].T + p[:, 4]
        if loss == "log" and k == 1:
            s = np.where(y == 1, 1, -1)
            value, dz = (cw[y] * np.log1p(np.exp(-s * z[:, 0]))).sum(), (-cw[y] * s / (1 + np.exp(s * z[:, 0])))[:, None]
        elif loss == "log":
            e = np.exp(z)
            pr = e / e.sum(axis=1, keepdims=True)
            value, dz = -(cw[y] * np.log(pr[np.arange(len(y)), y])).sum(), cw[y][:, None] * (pr - np.eye(classes)[y])
        else:
            s = np.where(y == 1, 1, -1)[:, None] if k == 1 else np.where(y[:, None] == np.arange(k), 1, -1)
            w = cw[y][:, None] if k == 1 else np.where(s > 0, cw[y][:, None], 1.0)
            gap = np.maximum(0, 1 - s * z)
            value, dz = (w * gap ** 2).sum(), -2 * w * s * gap
        reg = p.copy()
        if loss == "log":
            reg[:, 4] = 0
        g = np.concatenate([dz.T @ x, dz.sum(axis=0)[:, None]], axis=1)
        return value / total + (reg ** 2).sum() / (4.0 * total), g / total + reg / (2.0 * total)

    want = _descend(objective, (k, 5))
    got = np.concatenate([m.coef, m.intercept[:, None]], axis=1)
    if loss == "log" and k > 1:  # intercepts are free up to a common shift
        got[:, 4] -= got[:, 4].mean()
        want[:, 4] -= want[:, 4].mean()
    assert np.abs(got - want).max() < 1e-4


def test_training_needs_two_classes(spark):
    with pytest.raises(ValueError):
        L.fit_logistic(spark.createDataFrame([([0], [1.0], "a")], "idx array<int>, weight array<double>, y string"), "y", 1)


def test_streams_equal_batches(spark):
    import __spark_entry__ as E
    q = E.queries()
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(q["stream_tfidf"](spark, SF0001)) == key(q["tfidf_weights"](spark, SF0001))
    assert key(q["stream_score_binary"](spark, SF0001)) == key(q["score_binary"](spark, SF0001))
    assert key(q["stream_score_multiclass"](spark, SF0001)) == key(q["score_multiclass"](spark, SF0001))
    assert key(q["stream_top_features"](spark, SF0001)) == key(q["top_features_of_class"](spark, SF0001))


def test_batches_are_weighed_in_bounded_pieces(monkeypatch):
    """A step of a task holds a bounded number of words; a longer row is a piece of its own, no row is lost."""
    import pyarrow as pa
    from loomtext.operators import rowvectors as RV
    monkeypatch.setattr(RV, "PIECE", 10)
    sizes = [3, 0, 6, 2, 25, 0, 1, 10, 4]
    b = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), pa.array([["w"] * n for n in sizes], pa.list_(pa.string()))], ["id", "u"])
    got = [p.column("u").to_pylist() for p in RV.pieces(b.slice(1), "u")]
    assert [len(x) for p in got for x in p] == sizes[1:]
    assert all(len(p) == 1 or sum(map(len, p)) <= 10 for p in got)
    assert list(RV.pieces(b.slice(0, 0), "u")) == []
    model = pa.array(["w", "w w"])
    whole = RV.row_tfidf(b.column("u"), model, np.array([1.0, 2.0]), True)
    parts = [RV.row_tfidf(p.column("u"), model, np.array([1.0, 2.0]), True) for p in RV.pieces(b, "u")]
    for i in range(2):
        assert [r for p in parts for r in p[i].to_pylist()] == whole[i].to_pylist()
