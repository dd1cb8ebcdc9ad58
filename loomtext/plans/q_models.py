"""Registered queries: model training and scoring (F8, F9, F11-F15), TF-IDF and scoring on a stream.

Training is iterative (no SQL oracle): the driver records a rows-only check
and pytest holds the coefficients against a brute-force fit. ``scores_table`` and the streams have an oracle.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions import tokens as TK
from ..operators import linear as L
from ..operators import models as M
from ..operators import rowvectors as RV
from ..operators import splits as SP
from ..operators import vectors as V
from ..session import ensure_checkpoint_dir, written_table
from ..sources import io as IO
from ..sources.tables import SCHEMAS, Tables
from ..streaming import rowwise as RW
from . import sqlgen as Q
from .q_extra import FEATURES_BY_CLASS_SQL, SCORE_BINARY_SQL, SCORE_MULTICLASS_SQL
from .q_vectors import DOC_MODEL_SQL, MAX_DF, MAX_FEATURES, MIN_DF, doc_tokens
from .registry import query

VOCAB = 20_000


def _features(t: Tables):
    """(doc_id, idx, weight) of every document's cleaned text and the fitted vocabulary."""
    docs = written_table(t.documents.select("doc_id", TK.terms(TX.clean_for_classification("text")).alias("units")), "units")
    model = RV.fit_terms(docs, "units", docs.count(), VOCAB)
    return model, model.vectors(docs, "units", ["doc_id"])


def _binary(t: Tables):
    model, feats = _features(t)
    lab = SP.stratified_split(t.labels.select("doc_id", "toxic"), "toxic", "doc_id")
    data = written_table(feats.join(lab, "doc_id"), "features")  # every training pass reads it
    fitted = L.fit_logistic(data.filter(F.col("split") == "train"), "toxic", len(model.terms))
    return model, fitted, data.filter(F.col("split") != "train")


@query("train_logreg")
def q_logreg(spark, d):
    _, fitted, test = _binary(Tables(spark, d))
    scored = RV.score_binary_rows(test, ["doc_id", "toxic"], fitted.coef, float(fitted.intercept[0]))
    return scored.select("doc_id", "toxic", F.round("prob", 6).alias("prob"), "pred")


@query("top_features")
def q_top_features(spark, d):
    model, fitted, test = _binary(Tables(spark, d))
    out = RV.top_features_rows(test, ["doc_id"], model, fitted.coef, n=5)
    return out.select("doc_id", "term", F.round("contribution", 6).alias("contribution"), "rank")


@query("train_linear_svc")
def q_svc(spark, d):
    t = Tables(spark, d)
    model, feats = _features(t)
    docs = SP.stratified_split(t.documents.select("doc_id", "lang"), "lang", "doc_id")
    data = written_table(feats.join(docs, "doc_id"), "features")
    fitted = L.fit_squared_hinge(data.filter(F.col("split") == "train"), "lang", len(model.terms))
    out = RV.score_multiclass_rows(data.filter(F.col("split") != "train"), ["doc_id"], *_per_class(fitted))
    return out.select("doc_id", "label_pred", F.round("confidence", 6).alias("confidence"))


def _per_class(fitted: L.LinearModel):
    """Coefficients and intercepts of every class: of two classes, the first has margin 0."""
    if len(fitted.classes) > 2:
        return fitted.coef, fitted.intercept, fitted.classes
    return np.vstack([np.zeros_like(fitted.coef), fitted.coef]), np.append(0.0, fitted.intercept), fitted.classes


# ---------------------------------------------------------------------------
# F4, F11-F13 on a stream: fitted once on the table, then applied to documents as they come
# ---------------------------------------------------------------------------
def _streamed(spark, d, step):
    """``step(model, vectors or rows)`` on the stream of documents, through the exactly-once file sink."""
    ensure_checkpoint_dir(spark)
    fitted, _ = V.fit_tfidf(doc_tokens(Tables(spark, d)), "doc_id", "tokens_str", MIN_DF, MAX_DF, MAX_FEATURES)
    sdf = RW.table_stream(spark, d, "documents", SCHEMAS["documents"])
    words = TK.terms(TK.tokens_str(TK.token_chain("text", cleaner="embeddings")))
    out = RW.apply_rowwise(sdf, lambda s: step(fitted.rows, s.select(F.col("doc_id").alias("id"), words.alias("units"))))
    path = IO.scratch_dir(spark, "stream")
    RW.run_available(out, path, path + "-ckpt")
    return spark.read.schema(out.schema).parquet(path)


def _rule_coef(model: RV.TermModel, classes: int) -> np.ndarray:
    """The rule-derived coefficients of the scoring queries."""
    n = np.array([len(t) for t in model.terms], dtype=np.int64)
    return np.stack([(((n + c) % 5) - 2) / 10.0 for c in range(classes)])


@query("stream_tfidf", f"WITH {DOC_MODEL_SQL} SELECT id AS doc_id, term, round(weight, 6) AS weight FROM dw")
def q_stream_tfidf(spark, d):
    out = _streamed(spark, d, lambda m, s: m.long(s, "units", ["id"]))
    return out.select(F.col("id").alias("doc_id"), "term", F.round("weight", 6).alias("weight"))


@query("stream_score_binary", SCORE_BINARY_SQL)
def q_stream_binary(spark, d):
    out = _streamed(spark, d, lambda m, s: RV.score_binary_rows(m.weighed(s, "units", ["id"]), ["id"], _rule_coef(m, 1), -0.1))
    return out.select("id", F.round("prob", 6).alias("prob"), "pred")


@query("stream_score_multiclass", SCORE_MULTICLASS_SQL)
def q_stream_multiclass(spark, d):
    out = _streamed(spark, d, lambda m, s: RV.score_multiclass_rows(
        m.weighed(s, "units", ["id"]), ["id"], _rule_coef(m, 3), [0.0] * 3, ["negative", "neutral", "positive"]))
    return out.select("id", "label_pred", F.round("confidence", 6).alias("confidence"))


@query("stream_top_features", FEATURES_BY_CLASS_SQL)
def q_stream_top_features(spark, d):
    def step(m, s):
        coef = _rule_coef(m, 3)
        scored = m.weighed(s, "units", ["id"]).with_class("cls", coef, [0.0] * 3)
        return RV.top_features_rows(scored, ["id", "cls"], m, coef, n=8, cls="cls")

    out = _streamed(spark, d, step)
    return out.select("id", "cls", "term", F.round("contribution", 6).alias("contribution"), "rank")


@query("kmeans")
def q_kmeans(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", V.l2_normalize("embedding").alias("vec"))
    return M.kmeans(e, "vec").select("vec_id", "cluster")


@query("scores_table", """
WITH a AS (SELECT vec_id, 'a' AS label, CAST(embedding[1] AS DOUBLE) AS s FROM embeddings
  UNION ALL SELECT vec_id, 'b', CAST(embedding[2] AS DOUBLE) FROM embeddings
  UNION ALL SELECT vec_id, 'c', CAST(embedding[3] AS DOUBLE) FROM embeddings)
SELECT vec_id, label, round(s, 6) AS score, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS rank FROM a""")
def q_scores_table(spark, d):
    e = Tables(spark, d).embeddings
    m = F.create_map(F.lit("a"), F.col("embedding")[0].cast("double"),
                     F.lit("b"), F.col("embedding")[1].cast("double"),
                     F.lit("c"), F.col("embedding")[2].cast("double"))
    return M.scores_table(e.select("vec_id", m.alias("scores")), "vec_id", "scores").select(
        "vec_id", "label", "score", F.col("rank"))
