"""Quality classifier by positive-unlabelled learning.

A small network scores a text from its shape: how its character classes follow
each other, how much it repeats itself, how long its words and lines are. It is
trained on trusted positives (rows labelled 1) and unlabelled web text (any
documents, whatever their label) by minimising the non-negative unbiased risk

    prior * E_P[l(f, +)] + max(0, E_U[l(f, -)] - prior * E_P[l(f, -)])

with logistic loss; where the second part falls below zero, its gradient is
followed upward instead, which keeps the network from fitting the unlabelled
rows as negatives. The class prior is the share of positives among the labels
of the training folds.

The classifier is fitted on a bounded sample (``sample`` rows of either kind,
chosen by a hash of doc_id); every document is scored, over its whole text.

Defined cases: null, empty and wordless texts score 0; repeated rows are scored
each; labels that are null, or whose doc_id is null, teach nothing; without any
positive label every text with words scores 1 (no ground to reject); other
columns are ignored.
"""
from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, whole_text

SAMPLE = 12_000      # positives, and as many unlabelled rows, at most
FOLDS = 5
THRESHOLD = 0.3
HIDDEN = 24
STEPS = 1000
SEED = 7

# Character classes by UTF-8 byte: 0 other control, then as named.
_CLASSES = np.zeros(256, dtype=np.uint8)
for _k, _chars in enumerate((" ", "\t\r\x0b\x0c", "\n", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                             "0123456789", ".", ",", "!?", ";:", "'\"", "()[]{}<>", "-_/\\", "#$%&*+=@^~`|"), 1):
    for _c in _chars:
        _CLASSES[ord(_c)] = _k
_CLASSES[128:] = 15


def features(text: str | None) -> np.ndarray | None:
    """Shape of a whole text; None without words."""
    words = text.split() if text else []
    if not words:
        return None
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    classes = _CLASSES[data]
    single = np.bincount(classes, minlength=16) / len(classes)
    if len(classes) > 1:
        follow = np.bincount(classes[:-1] * np.uint8(16) + classes[1:], minlength=256) / (len(classes) - 1)
    else:
        follow = np.zeros(256)
    often = Counter(words)
    n, kinds = len(words), len(often)
    alike = sum(map(str.__eq__, words, words[1:])) / (n - 1) if n > 1 else 0.0
    pairs = len(set(zip(words, words[1:]))) / (n - 1) if n > 1 else 1.0
    lines = [x for x in text.split("\n") if x.strip()]
    letters = single[3] + single[4] + single[15]
    stats = (math.log1p(n), math.log1p(len(data)), kinds / n, math.log1p(kinds), pairs, len(data) / n / 10,
             len(set(lines)) / len(lines), math.log1p(len(lines)), n / len(lines) / 50, letters,
             single[4] / (letters + 1e-9), math.log1p(max(map(len, words))), float(n < 5), kinds / math.sqrt(n) / 10,
             alike, max(often.values()) / n)
    return np.concatenate([np.sqrt(follow), np.sqrt(single), stats]).astype(np.float32)


class Network:
    """One hidden layer over standardised features."""

    def __init__(self, mean, scale, weights):
        self.mean, self.scale, self.weights = mean, scale, weights

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w1, b1, w2, b2 = self.weights
        h = np.tanh(x @ w1 + b1)
        return h, h @ w2 + b2

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.hidden(self.standard(x))[1])


def sigmoid(f: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(f, -40, 40)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS,
          hidden: int = HIDDEN, rate: float = 0.003, decay: float = 1e-4, seed: int = SEED) -> Network:
    """Minimise the non-negative risk by full-batch Adam steps."""
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    rng = np.random.default_rng(seed)
    k = positive.shape[1]
    w = [rng.normal(0, 1 / math.sqrt(k), (k, hidden)), np.zeros(hidden),
         rng.normal(0, 1 / math.sqrt(hidden), hidden), np.zeros(1)]
    net = Network(mean, scale, w)
    x = np.vstack([net.standard(positive), net.standard(unlabelled)]).astype(np.float64)
    is_p = np.arange(len(x)) < len(positive)
    n_p, n_u = len(positive), len(unlabelled)
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for t in range(1, steps + 1):
        h, f = net.hidden(x)
        p = sigmoid(f)
        minus = np.logaddexp(0, f)  # l(f, -); its slope is p, that of l(f, +) is p - 1
        negative_risk = minus[~is_p].mean() - prior * minus[is_p].mean()
        slope_plus = np.where(is_p, prior * (p - 1) / n_p, 0)
        slope_minus = np.where(is_p, -prior * p / n_p, p / n_u)
        g = slope_plus + slope_minus if negative_risk >= 0 else -slope_minus
        back = np.outer(g, w[2]) * (1 - h * h)
        grads = [x.T @ back + decay * w[0], back.sum(0), h.T @ g + decay * w[2], np.array([g.sum()])]
        for i, grad in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.999 * v[i] + 0.001 * grad * grad
            w[i] -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return net


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def _feature_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, x: float32 features as bytes) of texts with words."""
    arrow = pa.schema([("doc_id", pa.int64()), ("x", pa.binary())])

    def run(batches):
        for batch in batches:
            ids, xs = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if (x := features(text.as_py())) is not None:
                    ids.append(doc_id)
                    xs.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(xs, pa.binary())], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x binary")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS, seed: int = SEED) -> Network | None:
    """Train on at most ``sample`` positives of the training folds and as many unlabelled rows."""
    prepare(docs.sparkSession)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out(F.col("doc_id"), folds)))
    total = known.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("quality").cast("double")).alias("share")).first()
    if not total.n or not total.share:
        return None
    prior = min(max(float(total.share), 0.05), 0.98)

    def chosen(rows: DataFrame, salt: int) -> DataFrame:
        return rows.select("doc_id", F.xxhash64(F.lit(salt), "doc_id").alias("h")).orderBy("h", "doc_id").limit(sample)

    part = (chosen(known.where("quality = 1"), seed).select("doc_id", F.lit(True).alias("positive"))
            .unionByName(chosen(ids, seed + 1).select("doc_id", F.lit(False).alias("positive"))))
    picked = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
              .join(F.broadcast(part.select("doc_id").distinct()), "doc_id", "left_semi")  # 2 * sample ids at most
              .groupBy("doc_id").agg(F.min("text").alias("text")))  # of rows that repeat an id the least text
    rows = {r.doc_id: np.frombuffer(bytes(r.x), dtype=np.float32) for r in _feature_rows(picked).collect()}
    sides = {True: [], False: []}
    for r in sorted(part.collect(), key=lambda r: (r.positive, r.doc_id)):
        if r.doc_id in rows:
            sides[r.positive].append(rows[r.doc_id])
    if not sides[True] or not sides[False]:
        return None
    return train(np.array(sides[True]), np.array(sides[False]), prior, seed=seed)


def score_texts(docs: DataFrame, net: Network | None, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the ``extra`` columns, score: every row, over its whole text."""
    keep = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("__text"),
                       *(F.col(c) for c in extra))
    schema = keep.drop("__text").schema.add("score", "double")

    def run(batches):
        for batch in batches:
            xs = [features(t.as_py()) for t in batch.column("__text")]
            score = np.zeros(len(xs))
            has = [i for i, x in enumerate(xs) if x is not None]
            if has:
                score[has] = 1.0 if net is None else net.probability(np.array([xs[i] for i in has]))
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(score)],
                                             names=[*names, "score"])

    return keep.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS,
             threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    net = fit(docs, labels, sample, folds)
    scored = score_texts(docs, net)
    return scored.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
