"""Class weights, baselines, clustering, scoring tables (F7, F10-F15); training is in ``linear``, scoring row by row in ``rowvectors``."""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import SEED
from ..functions.scalars import argmax_label, softmax
from ..session import written_table
from .rowvectors import RowVectors, TermModel, top_features_rows


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """``n / (k * count(class))`` per class (one row per class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("__c"))
    # one row per class: the totals are two scalars
    r = counts.agg(F.sum("__c").alias("n"), F.count("*").alias("k")).first()
    n, k = int(r["n"] or 0), int(r["k"] or 0)
    return counts.select(label, (F.lit(float(n)) / (F.lit(k) * F.col("__c"))).alias("weight"))


def with_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Attach balanced weights; the class table is written, so that its size decides how it is joined."""
    return df.join(written_table(balanced_weights(df, label).withColumnRenamed("weight", out), "classes"), label)


def majority_baseline(train: DataFrame, test: DataFrame, label: str, out: str = "pred") -> DataFrame:
    """predict the most frequent training class (tie: smaller label)."""
    top = (train.groupBy(label).agg(F.count("*").alias("__c"))
           .orderBy(F.desc("__c"), label).limit(1).first())
    dtype = train.schema[label].dataType
    return test.withColumn(out, F.lit(top[label] if top else None).cast(dtype))


def dense_features(df: DataFrame, vec: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.transform(vec, lambda x: x.cast("double"))))


def coef_matrix(coefs: DataFrame, model: TermModel, classes: int) -> np.ndarray:
    """(classes, terms) of a model-sized table ``(term, cls, coef)``, or ``(term, coef)``; without a coefficient: NaN."""
    cols = coefs.select("term", (F.col("cls") if "cls" in coefs.columns else F.lit(0)).alias("cls"), F.col("coef").cast("double").alias("coef")).toArrow()
    at = pc.index_in(cols["term"], value_set=pa.array(model.terms, pa.string())).fill_null(-1).to_numpy()
    cls, own = cols["cls"].to_numpy(), at >= 0
    out = np.full((classes, len(model.terms)), np.nan)
    own &= (cls >= 0) & (cls < classes)
    out[cls[own], at[own]] = cols["coef"].to_numpy()[own]
    return out


def top_features(weights: DataFrame | RowVectors, coefs: DataFrame, n: int = 10, positive_only: bool = False, model: TermModel | None = None) -> DataFrame:
    """per document, weight x coefficient, largest contributions first. Of rows ``(id, idx, weight)`` of a fitted
    vocabulary each is ranked within itself; a long table ``(id, term, weight)`` is joined and sorted."""
    from pyspark.sql import Window
    if model is not None:
        return top_features_rows(weights, ["id"], model, coef_matrix(coefs, model, 1), n, positive_only)
    c = weights.join(coefs, "term").withColumn("contribution", F.round(F.col("weight") * F.col("coef"), 9))
    if positive_only:
        c = c.filter(F.col("contribution") > 0)
    w = Window.partitionBy("id").orderBy(F.desc("contribution"), "term")
    return c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def top_features_of_class(weights: DataFrame | RowVectors, coefs: DataFrame, predicted: DataFrame | str, n: int = 8, model: TermModel | None = None) -> DataFrame:
    """F13 for several classes: per document, weight x coefficient of its predicted class, largest first.

    ``coefs``: (term, cls, coef) of a one-vs-rest model; ``predicted``: (id, cls), or the column of rows ``(id, idx,
    weight)`` of a fitted vocabulary that holds the class (see ``top_features``). A class the model does not
    have, or a document without terms, gives no rows."""
    from pyspark.sql import Window
    if model is not None:
        rows, cls = (weights, predicted) if isinstance(predicted, str) else (weights.join(predicted.select("id", "cls"), "id"), "cls")
        classes = int(coefs.agg(F.max("cls")).first()[0] or 0) + 1
        return top_features_rows(rows, ["id", cls], model, coef_matrix(coefs, model, classes), n, cls=cls).withColumnRenamed(cls, "cls")
    c = (weights.join(predicted.select("id", "cls"), "id").join(coefs, ["term", "cls"])
         .select("id", "cls", "term", F.round(F.col("weight") * F.col("coef"), 9).alias("contribution")))
    w = Window.partitionBy("id").orderBy(F.desc("contribution"), "term")
    return c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def kmeans(df: DataFrame, vec: str, k: int = 100, seed: int = SEED, out: str = "cluster") -> DataFrame:
    """k = min(k, n) clusters on (unit) vectors."""
    n = df.count()
    feats = dense_features(df, vec, "__f")
    model = KMeans(k=max(1, min(k, n)), seed=seed, featuresCol="__f", predictionCol=out).fit(feats)
    return model.transform(feats).drop("__f")


def scores_table(df: DataFrame, id_col: str, scores: str, digits: int = 6) -> DataFrame:
    """class scores as rows, descending."""
    from pyspark.sql import Window
    e = df.select(id_col, F.explode(scores).alias("label", "score"))
    w = Window.partitionBy(id_col).orderBy(F.desc("score"), "label")
    return e.withColumn("score", F.round("score", digits)).withColumn("rank", F.row_number().over(w))


def linear_margins(weights: DataFrame, coefs: DataFrame, ids: DataFrame,
                   intercepts: Sequence[float]) -> DataFrame:
    """Margins of linear models as a join: ``(id, margins)``, one margin per
    class, from sparse ``(id, term, weight)`` and ``(term, cls, coef)``; terms
    without a coefficient contribute nothing, and an id of ``ids`` without a
    term is scored from the intercepts. The coefficient table is model-sized
    (vocabulary x classes) and broadcast."""
    wx = F.col("weight") * F.col("coef")
    n = len(intercepts)
    m = (weights.join(F.broadcast(coefs), "term").groupBy("id")
         .agg(*[F.sum(F.when(F.col("cls") == i, wx)).alias(f"m{i}") for i in range(n)]))
    margins = [F.coalesce(f"m{i}", F.lit(0.0)) + F.lit(float(b)) for i, b in enumerate(intercepts)]
    return ids.select("id").join(m, "id", "left").select("id", F.array(*margins).alias("margins"))


def score_binary_sql(weights: DataFrame, coefs: DataFrame, ids: DataFrame, intercept: float = 0.0,
                     threshold: float = 0.5) -> DataFrame:
    """F11 without a fitted object: ``1 / (1 + exp(-(sum w*x + b)))`` for every id."""
    m = linear_margins(weights, coefs.withColumn("cls", F.lit(0)), ids, [intercept])
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margins")[0]))
    return m.select("id", p.alias("prob")).withColumn("pred", (F.col("prob") >= threshold).cast("int"))


def score_multiclass_sql(weights: DataFrame, coefs: DataFrame, ids: DataFrame, labels: list[str],
                         intercepts: Sequence[float] | None = None) -> DataFrame:
    """F12 without a fitted object: per-class margins -> softmax -> best, for every id."""
    m = linear_margins(weights, coefs, ids, intercepts or [0.0] * len(labels))
    mp = F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), softmax("margins"))
    best = argmax_label(mp)
    return m.select("id", mp.alias("scores"), best["label"].alias("label_pred"),
                    best["confidence"].alias("confidence"))


# A form in more than one of HOT tokens is hot: there are fewer than HOT such forms.
HOT = 1000


def dictionary_join(df: DataFrame, id_col: str, tokens: str, dictionary: DataFrame,
                    bounded: bool = True, out: str = "mapped") -> DataFrame:
    """Replace tokens found in a ``(form, value)`` dictionary (one row a form), keep the
    others, order preserved. For dictionaries too large for a literal map:
    explode with position, left join, re-assemble per row (one row's tokens: bounded). A row without
    tokens keeps an empty list, a null token stays null.

    A bounded dictionary is broadcast. Of any other, the entries of hot tokens (fewer than ``HOT``) are broadcast
    and only the rest is joined by a shuffle, so a token in every row is no task of its own; tokens that are null
    meet no join."""
    ex = df.select(id_col, F.posexplode_outer(tokens).alias("__p", "form"))
    if bounded:
        j = ex.join(F.broadcast(dictionary), "form", "left")
    else:
        counts = ex.where(F.col("form").isNotNull()).groupBy("form").agg(F.count("*").alias("__n"))
        counts = written_table(counts, "forms")
        total = counts.agg(F.sum("__n")).first()[0] or 0
        hot = F.broadcast(counts.where(F.col("__n") * HOT > total).select("form", F.lit(True).alias("__hot")))
        entries = written_table(dictionary.join(hot, "form", "left"), "entries")
        marked = ex.join(hot, "form", "left")
        often = marked.where("__hot OR form IS NULL").drop("__hot").join(
            F.broadcast(entries.where("__hot").drop("__hot")), "form", "left")
        rest = marked.where("__hot IS NULL AND form IS NOT NULL").drop("__hot").join(
            entries.where("__hot IS NULL").drop("__hot"), "form", "left")
        j = often.unionByName(rest)
    j = j.select(id_col, "__p", F.coalesce("value", "form").alias("__t"))
    return (j.groupBy(id_col).agg(F.array_sort(F.collect_list(F.when(F.col("__p").isNotNull(), F.struct("__p", "__t")))).alias("__a"))
            .select(id_col, F.transform("__a", lambda s: s["__t"]).alias(out)))
