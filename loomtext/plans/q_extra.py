"""Registered queries for the remaining survey keys, each with its own entry."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import tokens as TK
from ..operators import models as M
from ..operators import retrieval as RT
from ..operators import rows as R
from ..operators import splits as SP
from ..operators import vectors as V
from ..sources.tables import Tables
from . import sqlgen as Q
from .q_vectors import DETAILS_SQL, DOC_MODEL_SQL, _norm_sql, details, doc_model, doc_vectors
from .registry import query

_STRIP = "^[" + Q.SP + "]+|[" + Q.SP + "]+$"


@query("tokens_str", f"SELECT doc_id, array_to_string({Q.tokenize('lower(text)')}, ' ') AS tokens_str FROM documents")
def q_tokens_str(spark, d):
    docs = Tables(spark, d).documents
    return docs.select("doc_id", TK.tokens_str(TK.tokenize(F.lower("text"))).alias("tokens_str"))


@query("apply_threshold", "SELECT event_id, CAST(value / 50.0 >= 0.35 AS INTEGER) AS pred FROM events")
def q_apply_threshold(spark, d):
    e = Tables(spark, d).events
    return e.select("event_id", S.apply_threshold(F.col("value") / 50.0, 0.35).alias("pred"))


@query("clip", "SELECT event_id, least(greatest(value, 18.0), 70.0) AS clipped FROM events")
def q_clip(spark, d):
    return Tables(spark, d).events.select("event_id", S.clip("value", 18.0, 70.0).alias("clipped"))


@query("round4", "SELECT event_id, round(value / 3.0, 4) AS rounded FROM events")
def q_round4(spark, d):
    return Tables(spark, d).events.select("event_id", S.round4(F.col("value") / 3.0).alias("rounded"))


# G9-G11 as their own tables (one metric per query, from the shared details)
@query("same_value_at_k", f"WITH {DETAILS_SQL} SELECT method, qid, round(same_segment_at_k, 6) AS same_segment_at_k FROM details")
def q_same_value(spark, d):
    return details(Tables(spark, d)).select("method", "qid", F.round("same_segment_at_k", 6).alias("same_segment_at_k"))


@query("same_city_at_k", f"WITH {DETAILS_SQL} SELECT method, qid, round(same_city_at_k, 6) AS same_city_at_k FROM details")
def q_same_city(spark, d):
    return details(Tables(spark, d)).select("method", "qid", F.round("same_city_at_k", 6).alias("same_city_at_k"))


@query("avg_age_diff", f"WITH {DETAILS_SQL} SELECT method, qid, round(avg_age_diff, 6) AS avg_age_diff FROM details")
def q_age_diff(spark, d):
    return details(Tables(spark, d)).select("method", "qid", F.round("avg_age_diff", 6).alias("avg_age_diff"))


# ---------------------------------------------------------------------------
# Chat records from conversations (turn 0 = bio, turn 1 = reply),
# 75 personas held out for evaluation
# ---------------------------------------------------------------------------
def chat_records(t: Tables):
    c = t.conversations
    pairs = (c.groupBy(F.col("conv_id").alias("persona_id"))
             .agg(F.max(F.when(F.col("turn") == 0, F.col("text"))).alias("bio"),
                  F.max(F.when(F.col("turn") == 1, F.col("text"))).alias("reply"))
             .filter(F.col("bio").isNotNull() & F.col("reply").isNotNull()))
    rec = pairs.select(S.build_chat_record("persona_id", "bio", "reply", "gen", F.lit(0.5)).alias("r")).select("r.*")
    return SP.holdout_by_entity(rec, "persona_id", 75)


@query("build_bank_testset", f"""
WITH p AS (SELECT conv_id AS persona_id, max(CASE WHEN turn = 0 THEN text END) AS bio,
                  max(CASE WHEN turn = 1 THEN text END) AS reply FROM conversations GROUP BY conv_id),
r AS (SELECT * FROM p WHERE bio IS NOT NULL AND reply IS NOT NULL),
e AS (SELECT persona_id FROM r ORDER BY {Q.md5key('persona_id')}, persona_id LIMIT 75),
s AS (SELECT r.*, CASE WHEN e.persona_id IS NULL THEN 'train' ELSE 'eval' END AS split FROM r LEFT JOIN e USING (persona_id)),
bank AS (SELECT row_number() OVER (ORDER BY persona_id, reply) - 1 AS id, persona_id, reply AS text
         FROM s WHERE split = 'train')
SELECT 'bank' AS kind, id, persona_id, text FROM bank
UNION ALL SELECT 'test', NULL, persona_id,
  {Q.rx("split_part(regexp_replace('Bio: ' || bio || chr(10) || 'Write an icebreaker.', '^Bio: ', ''), chr(10), 1)", _STRIP, '')} || ' | ' || reply
FROM s WHERE split <> 'train'""")
def q_bank(spark, d):
    bank, test = RT.build_bank_testset(chat_records(Tables(spark, d)))
    b = bank.select(F.lit("bank").alias("kind"), "id", "persona_id", F.col("icebreaker").alias("text"))
    t = test.select(F.lit("test").alias("kind"), F.lit(None).cast("long").alias("id"), "persona_id",
                    F.concat("bio", F.lit(" | "), "gold_icebreaker").alias("text"))
    return b.unionByName(t)


@query("semi_by_set", "SELECT doc_id, toxic FROM labels WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def q_semi(spark, d):
    t = Tables(spark, d)
    return SP.route_records(t.labels.select("doc_id", "toxic"),
                            t.documents.filter(F.col("lang") == "en").select("doc_id"), "doc_id")


@query("theta_similarity", f"""
WITH v AS (SELECT vec_id, {_norm_sql('embedding')} AS vec FROM embeddings)
SELECT a.vec_id AS qid, b.vec_id AS cid, round(list_dot_product(a.vec, b.vec), 6) AS score
FROM v a, v b WHERE a.vec_id <> b.vec_id AND round(list_dot_product(a.vec, b.vec), 6) >= 0.25""")
def q_theta(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", V.l2_normalize("embedding").alias("vec"))
    return V.dense_pairs(e, "vec_id", "vec", e, "vec_id", "vec", exclude_self=True, min_score=0.25)


_SOME_EMPTY = "CASE WHEN conv_id % 10 = 0 AND turn = 0 THEN ' ' ELSE lower(text) END"


@query("dictionary_join", f"""
SELECT conv_id, turn, {Q.lemmatize(Q.tokenize(_SOME_EMPTY))} AS mapped FROM conversations""")
def q_dictionary(spark, d):
    # every tenth conversation's first turn is blank: a row without tokens stays
    blank = (F.col("conv_id") % 10 == 0) & (F.col("turn") == 0)
    c = Tables(spark, d).conversations.select(
        F.struct("conv_id", "turn").alias("key"),
        TK.tokenize(F.when(blank, F.lit(" ")).otherwise(F.lower("text"))).alias("tokens"))
    # the dictionary is data-derived (every distinct token with a different
    # lemma): not bounded, so it is joined by shuffle, not broadcast
    forms = c.select(F.explode("tokens").alias("form")).distinct()
    dictionary = forms.select("form", TK.lemma(F.col("form")).alias("value")).filter(F.col("form") != F.col("value"))
    out = M.dictionary_join(c, "key", "tokens", dictionary, bounded=False)
    return out.select(F.col("key.conv_id").alias("conv_id"), F.col("key.turn").alias("turn"), "mapped")


# ---------------------------------------------------------------------------
# F11/F12 linear scoring as joins with a coefficient table (rule-derived)
# ---------------------------------------------------------------------------
def _coefs(t: Tables, model, classes: int = 1):
    terms = t.spark.createDataFrame([(x,) for x in model.rows.terms], "term string")
    return terms.select("term", F.explode(F.sequence(F.lit(0), F.lit(classes - 1))).alias("cls")) \
        .withColumn("coef", (((F.length("term") + F.col("cls")) % 5) - 2) / 10.0)


SCORE_BINARY_SQL = f"""WITH {DOC_MODEL_SQL},
cf AS (SELECT term, ((length(term) % 5) - 2) / 10.0 AS coef FROM vocab),
m AS (SELECT d.doc_id AS id, coalesce(sum(weight * coef), 0.0) AS margin FROM documents d
      LEFT JOIN dw ON dw.id = d.doc_id LEFT JOIN cf USING (term) GROUP BY d.doc_id)
SELECT id, round(1.0 / (1.0 + exp(-(margin - 0.1))), 6) AS prob,
       CAST(1.0 / (1.0 + exp(-(margin - 0.1))) >= 0.5 AS INTEGER) AS pred FROM m"""


@query("score_binary", SCORE_BINARY_SQL)
def q_score_binary(spark, d):
    t = Tables(spark, d)
    model, w = doc_model(t)
    coefs = _coefs(t, model).select("term", "coef")
    out = M.score_binary_sql(w, coefs, t.documents.select(F.col("doc_id").alias("id")), intercept=-0.1)
    return out.select("id", F.round("prob", 6).alias("prob"), "pred")


SCORE_MULTICLASS_SQL = f"""WITH {DOC_MODEL_SQL},
cf AS (SELECT term, c AS cls, (((length(term) + c) % 5) - 2) / 10.0 AS coef FROM vocab, range(3) r(c)),
m AS (SELECT d.doc_id AS id, r.c AS cls, coalesce(sum(weight * coef), 0.0) AS margin
      FROM documents d CROSS JOIN range(3) r(c) LEFT JOIN dw ON dw.id = d.doc_id
      LEFT JOIN cf ON cf.term = dw.term AND cf.cls = r.c GROUP BY d.doc_id, r.c),
x AS (SELECT id, cls, margin, exp(margin - max(margin) OVER (PARTITION BY id)) AS e FROM m),
p AS (SELECT id, ['negative', 'neutral', 'positive'][cls + 1] AS label, e / sum(e) OVER (PARTITION BY id) AS s FROM x)
SELECT id, first(label ORDER BY s DESC, label) AS label_pred, round(max(s), 6) AS confidence FROM p GROUP BY id"""


@query("score_multiclass", SCORE_MULTICLASS_SQL)
def q_score_multi(spark, d):
    t = Tables(spark, d)
    model, w = doc_model(t)
    coefs = _coefs(t, model, 3)
    out = M.score_multiclass_sql(w, coefs, t.documents.select(F.col("doc_id").alias("id")),
                                 ["negative", "neutral", "positive"])
    return out.select("id", "label_pred", F.round("confidence", 6).alias("confidence"))


_FEATURE_SQL = """f AS (SELECT {ids}, term, round(weight * coef, 9) AS contribution FROM {source}),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY contribution DESC, term) AS rank FROM f)
SELECT {ids}, term, round(contribution, 6) AS contribution, rank FROM r WHERE rank <= {n}"""


FEATURES_BY_CLASS_SQL = (f"""WITH {DOC_MODEL_SQL},
cf AS (SELECT term, c AS cls, (((length(term) + c) % 5) - 2) / 10.0 AS coef FROM vocab, range(3) r(c)),
m AS (SELECT dw.id, cf.cls, sum(weight * coef) AS margin FROM dw JOIN cf USING (term) GROUP BY dw.id, cf.cls),
best AS (SELECT id, first(cls ORDER BY round(margin, 9) DESC, cls) AS cls FROM m GROUP BY id),
""" + _FEATURE_SQL.format(ids="id, cls", source="dw JOIN best USING (id) JOIN cf USING (term, cls)", n=8))


@query("top_features_of_class", FEATURES_BY_CLASS_SQL)
def q_top_of_class(spark, d):
    t = Tables(spark, d)
    model, units, _ = doc_vectors(t)
    coefs = _coefs(t, model, 3)
    best = model.rows.weighed(units, "units", ["id"]).with_class("cls", M.coef_matrix(coefs, model.rows, 3), [0.0] * 3)
    out = M.top_features_of_class(best, coefs, "cls", 8, model.rows)
    return out.select("id", F.col("cls").cast("long").alias("cls"), "term", F.round("contribution", 6).alias("contribution"), "rank")


@query("top_features_by_document", f"""WITH {DOC_MODEL_SQL},
cf AS (SELECT term, ((length(term) % 5) - 2) / 10.0 AS coef FROM vocab),
""" + _FEATURE_SQL.format(ids="id", source="dw JOIN cf USING (term) WHERE weight * coef > 0", n=10))
def q_top_by_document(spark, d):
    t = Tables(spark, d)
    model, units, _ = doc_vectors(t)
    w = model.rows.weighed(units, "units", ["id"])
    out = M.top_features(w, _coefs(t, model).select("term", "coef"), n=10, positive_only=True, model=model.rows)
    return out.select("id", "term", F.round("contribution", 6).alias("contribution"), "rank")
