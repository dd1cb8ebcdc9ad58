"""Model evaluation tables.

Everything starts from aggregates: counts per (truth, prediction) or per
distinct score. Cumulative sums over distinct scores use the distributed
prefix sum; thresholds are bucketed, never cross-joined with rows.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.prefix import prefix_sum, prefix_sums
from ..session import written_table


def _grid(spark, labels: Sequence) -> DataFrame:
    pairs = [(a, b) for a in labels for b in labels]
    arr = F.array(*[F.struct(F.lit(a).alias("y"), F.lit(b).alias("p")) for a, b in pairs])
    return spark.range(1).select(F.inline(arr))


def confusion_matrix(df: DataFrame, y: str, p: str, labels: Sequence) -> DataFrame:
    """H1: ``(y, p, n)`` for every label pair in the fixed order, zeros kept."""
    counts = df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count("*").alias("n"))
    return (_grid(df.sparkSession, labels).join(counts, ["y", "p"], "left")
            .select("y", "p", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def accuracy(df: DataFrame, y: str, p: str, digits: int = 6) -> DataFrame:
    """H2."""
    return df.agg(F.round(F.avg((F.col(y) == F.col(p)).cast("double")), digits).alias("accuracy"))


def precision_recall_f1(cm: DataFrame, digits: int = 6) -> DataFrame:
    """H3: per class from the confusion table; 0 (not NULL) on zero division."""
    tp = cm.filter(F.col("y") == F.col("p")).select(F.col("y").alias("label"), F.col("n").alias("tp"))
    row = cm.groupBy(F.col("y").alias("label")).agg(F.sum("n").alias("support"))
    col = cm.groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("predicted"))
    j = tp.join(row, "label").join(col, "label")
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    j = j.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return j.select(F.col("label").cast("string").alias("label"),
                    F.round("precision", digits).alias("precision"),
                    F.round("recall", digits).alias("recall"),
                    F.round(f1, digits).alias("f1"), F.col("support").cast("long").alias("support"))


def macro_weighted_f1(prf: DataFrame, digits: int = 6) -> DataFrame:
    """H4."""
    return prf.agg(F.round(F.avg("f1"), digits).alias("macro_f1"),
                   F.round(F.sum(F.col("f1") * F.col("support")) / F.sum("support"), digits)
                   .alias("weighted_f1"))


def classification_report(df: DataFrame, y: str, p: str, labels: Sequence, digits: int = 6) -> DataFrame:
    """H5: per-class rows, then accuracy, macro avg and weighted avg rows."""
    cm = confusion_matrix(df, y, p, labels)
    per = precision_recall_f1(cm, 12)
    acc = cm.agg((F.sum(F.when(F.col("y") == F.col("p"), F.col("n"))) / F.sum("n")).alias("a"),
                 F.sum("n").cast("long").alias("support"))
    macro = per.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                    F.avg("f1").alias("f1"), F.sum("support").cast("long").alias("support"))
    weighted = per.agg(*[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m)
                         for m in ("precision", "recall", "f1")],
                       F.sum("support").cast("long").alias("support"))
    r = lambda c: F.round(c, digits)
    rows = per.select("label", r("precision").alias("precision"), r("recall").alias("recall"),
                      r("f1").alias("f1"), "support")
    rows = rows.unionByName(acc.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                                       F.lit(None).cast("double").alias("recall"), r("a").alias("f1"), "support"))
    rows = rows.unionByName(macro.select(F.lit("macro avg").alias("label"), r("precision").alias("precision"),
                                         r("recall").alias("recall"), r("f1").alias("f1"), "support"))
    return rows.unionByName(weighted.select(F.lit("weighted avg").alias("label"), r("precision").alias("precision"),
                                            r("recall").alias("recall"), r("f1").alias("f1"), "support"))


def _totals(sc: DataFrame) -> tuple[int, int]:
    """Positives and negatives: one scalar row, used as literals."""
    r = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    return int(r["P"] or 0), int(r["N"] or 0)


def score_counts(df: DataFrame, y: str, score: str) -> DataFrame:
    """``(score, pos, neg)`` per distinct score: the input of H6-H8."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(y).cast("long")).alias("pos"),
        F.sum((1 - F.col(y)).cast("long")).alias("neg"))


def roc_curve(df: DataFrame, y: str, score: str, digits: int = 6) -> DataFrame:
    """H6: one point per distinct score (descending thresholds): cumulative
    true/false positive rates of ``score >= threshold``."""
    # the scoring lineage runs once: totals and running sums read the counts
    sc = written_table(score_counts(df, y, score), "scores")
    # rows scoring >= s = all rows minus those below s (ascending prefix)
    cum = prefix_sums(sc, ["score"], {"__pb": "pos", "__nb": "neg"}, inclusive=False)
    P, N = _totals(sc)
    return (cum.withColumn("P", F.lit(P)).withColumn("N", F.lit(N))
            .withColumn("tp", F.col("P") - F.col("__pb")).withColumn("fp", F.col("N") - F.col("__nb"))
            .select(F.col("score").alias("threshold"),
                    F.round(F.when(F.col("N") > 0, F.col("fp") / F.col("N")), digits).alias("fpr"),
                    F.round(F.when(F.col("P") > 0, F.col("tp") / F.col("P")), digits).alias("tpr")))


def roc_auc(df: DataFrame, y: str, score: str, digits: int = 6) -> DataFrame:
    """H7: Mann-Whitney rank sum with average ranks for ties."""
    sc = score_counts(df, y, score).withColumn("n", F.col("pos") + F.col("neg"))
    before = prefix_sum(sc, ["score"], "n", "__before", inclusive=False)
    ranked = before.withColumn("avg_rank", F.col("__before") + (F.col("n") + 1) / 2.0)
    agg = ranked.agg(F.sum(F.col("pos") * F.col("avg_rank")).alias("R"),
                     F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    auc = (F.col("R") - F.col("P") * (F.col("P") + 1) / 2.0) / (F.col("P") * F.col("N"))
    return agg.select(F.round(F.when((F.col("P") > 0) & (F.col("N") > 0), auc), digits).alias("auc"))


def thresholds(lo: float = 0.30, hi: float = 0.80, n: int = 100) -> np.ndarray:
    return np.linspace(lo, hi, n)


def threshold_sweep(df: DataFrame, y: str, score: str, lo: float = 0.30, hi: float = 0.80,
                    n: int = 100, digits: int = 6) -> DataFrame:
    """H8: F1 of ``score >= t`` for ``n`` evenly spaced thresholds.

    Each distinct score falls into the bucket of the largest threshold not
    above it; per-threshold counts are suffix sums over <= n buckets."""
    step = (hi - lo) / (n - 1)
    sc = score_counts(df, y, score)
    b0 = F.floor((F.col("score") - F.lit(lo)) / F.lit(step)).cast("int")
    t_of = lambda b: F.lit(lo) + b * F.lit(step)
    b1 = F.when(t_of(b0 + 1) <= F.col("score"), b0 + 1).when(t_of(b0) > F.col("score"), b0 - 1).otherwise(b0)
    bucket = F.least(F.greatest(b1, F.lit(-1)), F.lit(n - 1))
    per_b = sc.groupBy(bucket.alias("b")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    grid = df.sparkSession.range(n).select(F.col("id").cast("int").alias("b"))
    full = grid.join(per_b, "b", "left").fillna(0, ["pos", "neg"])
    w = Window.orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    P, _ = _totals(sc)
    cum = (full.withColumn("tp", F.sum("pos").over(w)).withColumn("fp", F.sum("neg").over(w))
           .withColumn("P", F.lit(P)))
    fn = F.col("P") - F.col("tp")
    den = 2 * F.col("tp") + F.col("fp") + fn
    f1 = F.when(den > 0, 2 * F.col("tp") / den).otherwise(F.lit(0.0))
    return cum.select(F.col("b").alias("idx"), F.round(t_of(F.col("b")), 10).alias("threshold"),
                      F.round(f1, digits).alias("f1"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """H9: first threshold with the highest F1 (lower cut on ties)."""
    return sweep.orderBy(F.desc("f1"), "threshold").limit(1)


def binary_summary(df: DataFrame, y: str, score: str, t: float = 0.5, model: str = "model",
                   digits: int = 4) -> DataFrame:
    """One H10 row: accuracy, precision, recall, F1 of class 1, AUC."""
    pred = (F.col(score) >= F.lit(t)).cast("int")
    c = df.agg(F.sum(((pred == 1) & (F.col(y) == 1)).cast("long")).alias("tp"),
               F.sum(((pred == 1) & (F.col(y) == 0)).cast("long")).alias("fp"),
               F.sum(((pred == 0) & (F.col(y) == 1)).cast("long")).alias("fn"),
               F.count("*").alias("n"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    f1 = F.when(den > 0, 2 * F.col("tp") / den).otherwise(0.0)
    acc = (F.col("n") - F.col("fp") - F.col("fn")) / F.col("n")
    counts = c.columns
    # two one-row tables side by side: stacked, then the one value of every column
    both = c.unionByName(roc_auc(df, y, score, 12), allowMissingColumns=True)
    c = both.agg(*[F.max(k).alias(k) for k in [*counts, "auc"]])
    return (c.select(F.lit(model).alias("model"), F.round(acc, digits).alias("accuracy"),
                    F.round(prec, digits).alias("precision"), F.round(rec, digits).alias("recall"),
                    F.round(f1, digits).alias("f1"), F.round("auc", digits).alias("auc")))


def model_comparison(rows: Sequence[DataFrame]) -> DataFrame:
    """Stack one summary row per model."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
