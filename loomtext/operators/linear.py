"""Linear classifiers trained to convergence (F8, F9): logistic and squared-hinge loss.

The rows stay in Spark, as sparse vectors (``idx``, ``weight``). One pass sums loss and gradient over all rows:
every task adds up its own rows, the partial sums of tasks meet by slices of the gradient and a salt, and the
driver holds vectors of the model's size (classes x terms) only. L-BFGS steps on these gradients until the
largest gradient component is within ``tol``; all classes of a one-vs-rest model share a pass.

Rows with a null label are not trained on. Classes are the labels in ascending order.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .rowvectors import _list, pieces, row_margins

MAX_CLASSES = 1000     # more labels than this are an error, not a model
SLICE = 1 << 16        # gradient components that meet in one group
SALTS = 16             # partial sums of a slice that reach the driver
TOL = 1e-4             # largest gradient component, of the loss per unit of weight, at convergence


@dataclass
class LinearModel:
    """``coef`` (problems, terms) and ``intercept``; a binary model has one problem, of its second class."""
    classes: list
    coef: np.ndarray
    intercept: np.ndarray
    iterations: int
    converged: bool


def logistic(margins: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted loss and its derivative by margin; with several columns, the multinomial loss."""
    if margins.shape[1] == 1:
        s = np.where(y == 1, 1.0, -1.0)[:, None]
        z = s * margins
        return float((w * np.logaddexp(0.0, -z)).sum()), -w * s * 0.5 * (1.0 - np.tanh(z / 2.0))
    top = margins.max(axis=1, keepdims=True)
    e = np.exp(margins - top)
    total = e.sum(axis=1, keepdims=True)
    hit = np.zeros_like(margins)
    hit[np.arange(len(y)), y] = 1.0
    return float((w * hit * (np.log(total) + top - margins)).sum()), w[np.arange(len(y)), y][:, None] * (e / total - hit)


def squared_hinge(margins: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
    """One problem per column: the column's class against the rest."""
    own = (y == 1)[:, None] if margins.shape[1] == 1 else y[:, None] == np.arange(margins.shape[1])[None, :]
    s = np.where(own, 1.0, -1.0)
    gap = np.maximum(0.0, 1.0 - s * margins)
    return float((w * gap * gap).sum()), -2.0 * w * s * gap


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, tol: float, max_iter: int,
             memory: int = 10) -> tuple[np.ndarray, int, bool]:
    """L-BFGS with backtracking; returns the point, the iterations and whether the gradient is within ``tol``."""
    value, grad = f(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for it in range(max_iter):
        if np.abs(grad).max(initial=0.0) <= tol:
            return x, it, True
        d, alphas = grad.copy(), []
        for s, y in reversed(steps):
            a = (s @ d) / (s @ y)
            alphas.append(a)
            d -= a * y
        if steps:
            s, y = steps[-1]
            d *= (s @ y) / (y @ y)
        for (s, y), a in zip(steps, reversed(alphas)):
            d += (a - (y @ d) / (s @ y)) * s
        slope = -(grad @ d)
        step = 1.0 if steps else 1.0 / np.linalg.norm(grad)
        while True:
            new_x = x - step * d
            new_value, new_grad = f(new_x)
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 2.0
            if step < 1e-12:
                return x, it, False
        s, y = new_x - x, new_grad - grad
        if s @ y > 1e-14:
            steps = (steps + [(s, y)])[-memory:]
        x, value, grad = new_x, new_value, new_grad
    return x, max_iter, bool(np.abs(grad).max(initial=0.0) <= tol)


def _sum_parts(key, table):
    total = sum(np.frombuffer(p.as_py()) for p in table["part"])
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})


def _gradient(rows: DataFrame, loss, size: int, class_weight: np.ndarray, rest_weight: float | None):
    """``f(params) -> (loss, gradient)`` summed over all rows; params are (problems, size + 1), intercepts last."""
    sc = rows.sparkSession.sparkContext

    def evaluate(params: np.ndarray) -> tuple[float, np.ndarray]:
        shared = sc.broadcast(params)

        def partial(batches):
            p = shared.value
            total, value = np.zeros_like(p), 0.0
            for b in (p for b in batches for p in pieces(b, "idx")):
                idx, weight = _list(b.column("idx")), _list(b.column("weight"))
                y = b.column("y").to_numpy(zero_copy_only=False)
                w = np.repeat(class_weight[y][:, None], len(p), axis=1)
                if rest_weight is not None and len(p) > 1:
                    w = np.where(y[:, None] == np.arange(len(p))[None, :], w, rest_weight)
                v, dm = loss(row_margins(idx, weight, p[:, :-1], p[:, -1]), y, w)
                value += v
                row = np.repeat(np.arange(len(idx)), np.diff(idx.offsets.to_numpy()))
                i, x = idx.flatten().to_numpy(), weight.flatten().to_numpy()
                for k in range(len(p)):
                    total[k, :-1] += np.bincount(i, x * dm[row, k], minlength=size)
                    total[k, -1] += dm[:, k].sum()
            flat = np.append(total.ravel(), value)
            starts = range(0, len(flat), SLICE)
            salt = TaskContext.get().partitionId() % SALTS
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(starts)), pa.int32()), pa.array([salt] * len(starts), pa.int32()),
                 pa.array([flat[s:s + SLICE].tobytes() for s in starts], pa.binary())], ["slice", "salt", "part"])

        out = (rows.mapInArrow(partial, "slice int, salt int, part binary").groupBy("slice", "salt")
               .applyInArrow(_sum_parts, "slice int, part binary").collect())
        shared.destroy()
        flat = np.zeros(params.size + 1)
        for r in out:
            part = np.frombuffer(r["part"])
            flat[r["slice"] * SLICE:r["slice"] * SLICE + len(part)] += part
        return flat[-1], flat[:-1].reshape(params.shape)

    return evaluate


def _train(df: DataFrame, label: str, size: int, loss, C: float, balanced: bool, tol: float, max_iter: int,
           one_vs_rest: bool) -> LinearModel:
    ship_package(df.sparkSession)
    known = df.where(F.col(label).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(label).count().limit(MAX_CLASSES + 1).collect()}
    if not 2 <= len(counts) <= MAX_CLASSES:
        raise ValueError(f"{len(counts)} classes; 2 to {MAX_CLASSES} can be told apart")
    classes = sorted(counts)
    n = sum(counts.values())
    cw = np.array([n / (len(classes) * counts[c]) if balanced else 1.0 for c in classes])
    total = float(sum(cw[i] * counts[c] for i, c in enumerate(classes)))
    problems = 1 if len(classes) == 2 else len(classes)
    y = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    rows = known.select(y.cast("int").alias("y"), "idx", "weight").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sums = _gradient(rows, loss, size, cw, 1.0 if one_vs_rest else None)
        penalty = np.full((problems, size + 1), 1.0 / (C * total))
        if not one_vs_rest:
            penalty[:, -1] = 0.0  # a free intercept

        def f(flat: np.ndarray) -> tuple[float, np.ndarray]:
            p = flat.reshape(penalty.shape)
            value, grad = sums(p)
            return value / total + 0.5 * float((penalty * p * p).sum()), (grad / total + penalty * p).ravel()

        x, it, done = minimise(f, np.zeros(penalty.size), tol, max_iter)
    finally:
        rows.unpersist()
    p = x.reshape(penalty.shape)
    return LinearModel(classes, p[:, :-1], p[:, -1], it, done)


def fit_logistic(df: DataFrame, label: str, size: int, C: float = 1.0, balanced: bool = True, tol: float = TOL,
                 max_iter: int = 1000) -> LinearModel:
    """F8: ``C * sum(w * loss) + |coef|^2 / 2`` at its minimum, the intercept free; three classes and more are multinomial."""
    return _train(df, label, size, logistic, C, balanced, tol, max_iter, False)


def fit_squared_hinge(df: DataFrame, label: str, size: int, C: float = 1.0, balanced: bool = True, tol: float = TOL,
                      max_iter: int = 1000) -> LinearModel:
    """one class against the rest, squared hinge, the intercept penalised as a coefficient; a balanced weight
    counts for the rows of a problem's own class, its other rows weigh 1 (with two classes both have theirs)."""
    return _train(df, label, size, squared_hinge, C, balanced, tol, max_iter, True)
