"""Registered queries: evaluation tables (H*), judge summaries, entity joins, language."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import scalars as S
from ..operators import classify as C
from ..operators import lang as L
from ..operators import splits as SP
from ..sources.tables import Tables
from . import sqlgen as Q
from .q_rows import _split_sql
from .registry import query

LANGS = ["de", "en", "es", "fr"]
STEP = (0.80 - 0.30) / 99


# ---------------------------------------------------------------------------
# Rule-based predictions on the driver tables (the operators are generic)
# ---------------------------------------------------------------------------
def lang_rule(text):
    t = F.lower(text)
    return (F.when(t.contains(" the "), "en").when(t.contains(" der ") | t.contains(" die "), "de")
            .when(t.contains(" le ") | t.contains(" la "), "fr").otherwise("es"))


LANG_RULE_SQL = """CASE WHEN contains(lower(text), ' the ') THEN 'en'
  WHEN contains(lower(text), ' der ') OR contains(lower(text), ' die ') THEN 'de'
  WHEN contains(lower(text), ' le ') OR contains(lower(text), ' la ') THEN 'fr' ELSE 'es' END"""


def scored(t: Tables):
    """Labelled documents with two rule scores in [0, 1]."""
    d = t.documents.join(t.labels, "doc_id")
    up = F.length(F.regexp_replace("text", "[^A-Z]", "")) / F.greatest(F.length("text"), F.lit(1))
    return d.select("doc_id", F.col("toxic").alias("y"),
                    F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(7.0) - F.log("n_chars"))), 6).alias("score"),
                    F.round(F.least(F.lit(1.0), up * 20.0), 6).alias("score2"))


SCORED_SQL = """sc AS (SELECT d.doc_id, l.toxic AS y, round(1.0 / (1.0 + exp(7.0 - ln(d.n_chars))), 6) AS score,
   round(least(1.0, length(regexp_replace(d.text, '[^A-Z]', '', 'g')) / greatest(length(d.text), 1) * 20.0), 6) AS score2
   FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

MC_SQL = f"mc AS (SELECT doc_id, lang AS y, {LANG_RULE_SQL} AS p FROM documents)"
GRID_SQL = ("g AS (SELECT a.l AS y, b.l AS p FROM (VALUES " + ", ".join(f"('{x}')" for x in LANGS) +
            ") a(l), (VALUES " + ", ".join(f"('{x}')" for x in LANGS) + ") b(l))")
CM_SQL = f"""{MC_SQL}, {GRID_SQL},
cc AS (SELECT y, p, count(*) AS n FROM mc GROUP BY y, p),
cm AS (SELECT g.y, g.p, CAST(coalesce(cc.n, 0) AS BIGINT) AS n FROM g LEFT JOIN cc ON g.y = cc.y AND g.p = cc.p)"""
PRF_SQL = f"""{CM_SQL},
tp AS (SELECT y AS label, n AS tp FROM cm WHERE y = p),
rw AS (SELECT y AS label, sum(n) AS support FROM cm GROUP BY y),
cl AS (SELECT p AS label, sum(n) AS predicted FROM cm GROUP BY p),
pr AS (SELECT label, tp, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
       CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM tp JOIN rw USING (label) JOIN cl USING (label)),
prf AS (SELECT label, precision, recall, CASE WHEN precision + recall > 0
        THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, CAST(support AS BIGINT) AS support FROM pr)"""


def multiclass(t: Tables):
    return t.documents.select("doc_id", F.col("lang").alias("y"), lang_rule(F.col("text")).alias("p"))


@query("confusion_matrix", f"WITH {CM_SQL} SELECT y, p, n FROM cm")
def q_cm(spark, d):
    return C.confusion_matrix(multiclass(Tables(spark, d)), "y", "p", LANGS)


@query("accuracy", f"WITH {MC_SQL} SELECT round(avg(CAST(y = p AS DOUBLE)), 6) AS accuracy FROM mc")
def q_acc(spark, d):
    return C.accuracy(multiclass(Tables(spark, d)), "y", "p")


@query("precision_recall_f1", f"""WITH {PRF_SQL}
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM prf""")
def q_prf(spark, d):
    cm = C.confusion_matrix(multiclass(Tables(spark, d)), "y", "p", LANGS)
    return C.precision_recall_f1(cm)


@query("macro_weighted_f1", f"""WITH {PRF_SQL}
SELECT round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM prf""")
def q_macro(spark, d):
    cm = C.confusion_matrix(multiclass(Tables(spark, d)), "y", "p", LANGS)
    return C.macro_weighted_f1(C.precision_recall_f1(cm, 12))


@query("classification_report", f"""WITH {PRF_SQL}
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM prf
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(CASE WHEN y = p THEN n END) / sum(n), 6), CAST(sum(n) AS BIGINT) FROM cm
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM prf
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM prf""")
def q_report(spark, d):
    return C.classification_report(multiclass(Tables(spark, d)), "y", "p", LANGS)


SC_COUNTS_SQL = f"""{SCORED_SQL},
s AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY score)"""


@query("roc_curve", f"""WITH {SC_COUNTS_SQL},
c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
      sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM s),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM s)
SELECT score AS threshold, round(CASE WHEN N > 0 THEN fp / N END, 6) AS fpr,
       round(CASE WHEN P > 0 THEN tp / P END, 6) AS tpr FROM c, t""")
def q_roc(spark, d):
    return C.roc_curve(scored(Tables(spark, d)), "y", "score")


def _auc_sql(col: str, name: str) -> str:
    return f"""s_{name} AS (SELECT {col} AS score, sum(y) AS pos, sum(1 - y) AS neg, count(*) AS n FROM sc GROUP BY {col}),
r_{name} AS (SELECT *, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             + (n + 1) / 2.0 AS avg_rank FROM s_{name}),
a_{name} AS (SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
   (sum(pos * avg_rank) - sum(pos) * (sum(pos) + 1) / 2.0) / (sum(pos) * sum(neg)) END AS auc FROM r_{name})"""


@query("roc_auc", f"WITH {SCORED_SQL}, {_auc_sql('score', 'a')} SELECT round(auc, 6) AS auc FROM a_a")
def q_auc(spark, d):
    return C.roc_auc(scored(Tables(spark, d)), "y", "score")


SWEEP_SQL = f"""{SCORED_SQL},
th AS (SELECT CAST(i AS INTEGER) AS idx, CAST(0.3 AS DOUBLE) + i * CAST({STEP!r} AS DOUBLE) AS t FROM range(100) r(i)),
tot AS (SELECT sum(y) AS P FROM sc),
cnt AS (SELECT th.idx, th.t, sum(CASE WHEN sc.score >= th.t AND sc.y = 1 THEN 1 ELSE 0 END) AS tp,
        sum(CASE WHEN sc.score >= th.t AND sc.y = 0 THEN 1 ELSE 0 END) AS fp FROM th, sc GROUP BY th.idx, th.t),
sw AS (SELECT idx, round(t, 10) AS threshold, round(CASE WHEN 2 * tp + fp + (P - tp) > 0
        THEN 2 * tp / (2 * tp + fp + (P - tp)) ELSE 0.0 END, 6) AS f1 FROM cnt, tot)"""


@query("threshold_sweep", f"WITH {SWEEP_SQL} SELECT idx, threshold, f1 FROM sw")
def q_sweep(spark, d):
    return C.threshold_sweep(scored(Tables(spark, d)), "y", "score")


@query("best_threshold", f"WITH {SWEEP_SQL} SELECT idx, threshold, f1 FROM sw ORDER BY f1 DESC, threshold LIMIT 1")
def q_best(spark, d):
    return C.best_threshold(C.threshold_sweep(scored(Tables(spark, d)), "y", "score"))


def _summary_sql(col: str, name: str) -> str:
    return f"""SELECT '{name}' AS model, round((count(*) - fp - fn) / count(*), 4) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 4) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 4) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 4) AS f1,
  round((SELECT auc FROM a_{name}), 4) AS auc
FROM (SELECT count(*) AS n, sum(CASE WHEN {col} >= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN {col} >= 0.5 AND y = 0 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN {col} < 0.5 AND y = 1 THEN 1 ELSE 0 END) AS fn FROM sc), sc GROUP BY tp, fp, fn"""


@query("model_comparison", f"""WITH {SCORED_SQL}, {_auc_sql('score', 'length')}, {_auc_sql('score2', 'upper')}
{_summary_sql('score', 'length')} UNION ALL {_summary_sql('score2', 'upper')}""")
def q_models(spark, d):
    s = scored(Tables(spark, d))
    return C.model_comparison([C.binary_summary(s, "y", "score", 0.5, "length"),
                               C.binary_summary(s.withColumn("score", F.col("score2")), "y", "score", 0.5, "upper")])


# ---------------------------------------------------------------------------
# H11-H13 judge replies stored as JSON text (built from events)
# ---------------------------------------------------------------------------
def judge_json():
    k = F.get_json_object("props", "$.k").cast("int")
    base = F.concat(F.lit('{"scores": {"overall": '), (k % 5 + 1).cast("string"),
                    F.lit(', "tone": '), ((k + 2) % 5 + 1).cast("string"))
    spec = F.when(F.col("event_type") != "view",
                  F.concat(F.lit(', "specificity": '), ((k + 4) % 5 + 1).cast("string"))).otherwise(F.lit(""))
    adh = (F.when(F.col("event_type") == "error", F.lit('}, "adherence": {"hallucination": true}}'))
           .when(F.col("event_type") == "signup", F.lit("}}"))
           .otherwise(F.lit('}, "adherence": {"hallucination": false}}')))
    return F.concat(base, spec, adh)


JUDGE_SQL = """j AS (SELECT event_id, '{"scores": {"overall": ' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 + 1 AS VARCHAR)
  || ', "tone": ' || CAST((CAST(json_extract_string(props, '$.k') AS INTEGER) + 2) % 5 + 1 AS VARCHAR)
  || CASE WHEN event_type <> 'view' THEN ', "specificity": ' || CAST((CAST(json_extract_string(props, '$.k') AS INTEGER) + 4) % 5 + 1 AS VARCHAR) ELSE '' END
  || CASE WHEN event_type = 'error' THEN '}, "adherence": {"hallucination": true}}'
          WHEN event_type = 'signup' THEN '}}' ELSE '}, "adherence": {"hallucination": false}}' END AS reply FROM events)"""


def judged(t: Tables):
    return t.events.select("event_id", judge_json().alias("reply"))


@query("judge_summary", f"""WITH {JUDGE_SQL}
SELECT round(avg(CAST(json_extract_string(reply, '$.scores.overall') AS DOUBLE)), 6) AS overall,
  round(avg(CAST(json_extract_string(reply, '$.scores.tone') AS DOUBLE)), 6) AS tone,
  round(avg(CAST(json_extract_string(reply, '$.scores.specificity') AS DOUBLE)), 6) AS specificity,
  count(json_extract_string(reply, '$.scores.specificity')) AS n_specificity FROM j""")
def q_judge(spark, d):
    j = judged(Tables(spark, d))
    g = lambda p: F.get_json_object("reply", p).cast("double")
    return j.agg(F.round(F.avg(g("$.scores.overall")), 6).alias("overall"),
                 F.round(F.avg(g("$.scores.tone")), 6).alias("tone"),
                 F.round(F.avg(g("$.scores.specificity")), 6).alias("specificity"),
                 F.count(g("$.scores.specificity")).alias("n_specificity"))


@query("adherence_rate", f"""WITH {JUDGE_SQL}
SELECT round(100.0 * avg(CASE WHEN json_extract_string(reply, '$.adherence.hallucination') = 'false' THEN 1.0 ELSE 0.0 END), 6)
  AS adherence_pct FROM j WHERE json_extract(reply, '$.adherence') IS NOT NULL""")
def q_adherence(spark, d):
    j = judged(Tables(spark, d))
    ok = F.get_json_object("reply", "$.adherence.hallucination") == "false"
    # replies without an adherence object are not judged; a missing flag inside one fails
    return j.where(F.get_json_object("reply", "$.adherence").isNotNull()).agg(F.round(100.0 * F.avg(F.when(ok, 1.0).otherwise(0.0)), 6).alias("adherence_pct"))


@query("weakest_examples", f"""WITH {JUDGE_SQL}
SELECT event_id, CAST(coalesce(CAST(json_extract_string(reply, '$.scores.overall') AS INTEGER), 5) AS INTEGER) AS score
FROM j WHERE json_extract(reply, '$.scores') IS NOT NULL ORDER BY score, event_id LIMIT 3""")
def q_weakest(spark, d):
    j = judged(Tables(spark, d))
    s = F.coalesce(F.get_json_object("reply", "$.scores.overall").cast("int"), F.lit(5))
    return j.where(F.get_json_object("reply", "$.scores").isNotNull()).select("event_id", s.alias("score")).orderBy("score", "event_id").limit(3)


# ---------------------------------------------------------------------------
# Requests per (persona, temperature); responses joined back
# ---------------------------------------------------------------------------
def requests(t: Tables):
    personas = t.conversations.select(F.col("conv_id").alias("persona_id")).distinct()
    temps = F.array(*[F.struct(F.lit(i).alias("temp_idx"), F.lit(v).alias("temperature"))
                      for i, v in enumerate(X.TEMPERATURES)])
    return personas.select("persona_id", F.inline(temps)).withColumn(
        "custom_id", F.concat(F.lit("p"), F.col("persona_id").cast("string"), F.lit("_t"),
                              F.col("temp_idx").cast("string")))


TEMPS_SQL = "(VALUES " + ", ".join(f"({i}, CAST({v} AS DOUBLE))" for i, v in enumerate(X.TEMPERATURES)) + ") tt(temp_idx, temperature)"


@query("cross_expand", f"""SELECT p.persona_id, tt.temp_idx, tt.temperature,
  'p' || CAST(p.persona_id AS VARCHAR) || '_t' || CAST(tt.temp_idx AS VARCHAR) AS custom_id
FROM (SELECT DISTINCT conv_id AS persona_id FROM conversations) p, {TEMPS_SQL}""")
def q_expand(spark, d):
    return requests(Tables(spark, d))


@query("join_response_entity", f"""WITH req AS (SELECT p.persona_id, tt.temp_idx, tt.temperature
  FROM (SELECT DISTINCT conv_id AS persona_id FROM conversations) p, {TEMPS_SQL}),
resp AS (SELECT event_id, 'p' || CAST(user_id AS VARCHAR) || '_t' || CAST(CAST(floor(value) AS BIGINT) % 4 AS VARCHAR) AS cid FROM events),
parsed AS (SELECT event_id, CAST(regexp_extract(cid, 'p(\\d+)_t(\\d+)', 1) AS BIGINT) AS persona_id,
  CAST(regexp_extract(cid, 'p(\\d+)_t(\\d+)', 2) AS INTEGER) AS temp_idx FROM resp)
SELECT r.event_id, r.persona_id, q.temperature FROM parsed r JOIN req q ON r.persona_id = q.persona_id AND r.temp_idx = q.temp_idx""".replace("\\\\", "\\"))
def q_join_resp(spark, d):
    t = Tables(spark, d)
    cid = F.concat(F.lit("p"), F.col("user_id").cast("string"), F.lit("_t"),
                   (F.floor("value").cast("long") % 4).cast("string"))
    resp = t.events.select("event_id", *S.parse_custom_id(cid))
    req = requests(t).select("persona_id", "temp_idx", "temperature")
    # the request table has (personas x temperatures) rows; an equi-join on both keys
    return resp.join(req, ["persona_id", "temp_idx"]).select("event_id", "persona_id", "temperature")


# ---------------------------------------------------------------------------
# B31 language detection; F7 balanced weights; F10 majority baseline
# ---------------------------------------------------------------------------
def _lang_sides(t: Tables):
    docs = t.documents.select("doc_id", "text", "lang")
    s = SP.stratified_split(docs, "lang", "doc_id")
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") != "train")


LANG_SQL = f"""sp AS ({_split_sql("documents", "doc_id", "lang", "doc_id, text, lang")}),
ch AS (SELECT doc_id, split, lang, unnest(range(1, len(cs) + 1)) AS i, unnest(cs) AS a
       FROM (SELECT *, regexp_extract_all(lower(coalesce(text, '')), '(?s).') AS cs FROM sp)),
tri AS (SELECT doc_id, split, lang, tri FROM (SELECT doc_id, split, lang, a || lead(a) OVER w || lead(a, 2) OVER w AS tri
        FROM ch WINDOW w AS (PARTITION BY doc_id ORDER BY i)) WHERE tri IS NOT NULL),
prof AS (SELECT lang, tri, count(*) AS c FROM tri WHERE split = 'train' AND lang IS NOT NULL GROUP BY lang, tri),
tot AS (SELECT lang, sum(c) AS T FROM prof GROUP BY lang),
v AS (SELECT count(DISTINCT tri) AS V FROM prof),
dt AS (SELECT doc_id, tri, count(*) AS cnt FROM tri WHERE split <> 'train' GROUP BY doc_id, tri),
n AS (SELECT doc_id, sum(cnt) AS n FROM dt GROUP BY doc_id),
hits AS (SELECT dt.doc_id, prof.lang, sum(cnt * ln(c + 1)) AS hit FROM dt JOIN prof USING (tri) GROUP BY 1, 2),
sc AS (SELECT n.doc_id, tot.lang, round(n.n * ln(1.0 / (tot.T + v.V)) + coalesce(h.hit, 0.0), 9) AS score
       FROM n CROSS JOIN tot CROSS JOIN v LEFT JOIN hits h ON h.doc_id = n.doc_id AND h.lang = tot.lang),
best AS (SELECT doc_id, first(lang ORDER BY score DESC, lang) AS lang FROM sc GROUP BY doc_id)
SELECT sp.doc_id, CASE WHEN length(sp.text) > 30 AND best.lang IS NOT NULL THEN best.lang ELSE 'und' END AS lang_pred
FROM sp LEFT JOIN best ON sp.doc_id = best.doc_id WHERE sp.split <> 'train'"""


@query("detect_language", f"WITH {LANG_SQL}")
def q_lang(spark, d):
    train, test = _lang_sides(Tables(spark, d))
    prof = L.fit_profiles(train, "text", "lang")
    return L.detect_language(test, "doc_id", "text", prof)


@query("balanced_weights", """
SELECT toxic, round((SELECT count(*) FROM labels) / (2.0 * count(*)), 6) AS weight FROM labels GROUP BY toxic""")
def q_balanced(spark, d):
    from ..operators.models import balanced_weights
    return balanced_weights(Tables(spark, d).labels, "toxic").withColumn("weight", F.round("weight", 6))


@query("majority_baseline", """
WITH m AS (SELECT quality FROM labels GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1)
SELECT l.doc_id, m.quality AS pred FROM labels l, m""")
def q_majority(spark, d):
    from ..operators.models import majority_baseline
    lab = Tables(spark, d).labels
    return majority_baseline(lab, lab, "quality").select("doc_id", "pred")
