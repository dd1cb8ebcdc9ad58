"""Registered queries: TF-IDF, similarity, recommendation and retrieval (F1-F6, G*, J5)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import tokens as TK
from ..operators import recmetrics as RM
from ..operators import retrieval as RT
from ..operators import rows as R
from ..operators import splits as SP
from ..operators import vectors as V
from ..session import written_table
from ..sources.tables import Tables
from . import sqlgen as Q
from .q_rows import _split_sql
from .registry import query

MIN_DF, MAX_DF, MAX_FEATURES, K = 2, 0.85, 50_000, 5
REL_T = 0.20  # relevance cut used on the driver's vectors (default 0.35)


# ---------------------------------------------------------------------------
# Spark side helpers
# ---------------------------------------------------------------------------
def doc_tokens(t: Tables):
    return t.documents.select("doc_id", TK.tokens_str(
        TK.token_chain("text", cleaner="embeddings")).alias("tokens_str"))


def bench_tokens(t: Tables):
    return t.benchmark.select(F.col("item_id").alias("doc_id"), TK.tokens_str(
        TK.token_chain("text", cleaner="embeddings")).alias("tokens_str"))


def doc_model(t: Tables):
    """Fitted model and document weights, computed from the written words wherever they are read."""
    return V.fit_tfidf(doc_tokens(t), "doc_id", "tokens_str", MIN_DF, MAX_DF, MAX_FEATURES)


def doc_vectors(t: Tables):
    """Fitted model, the documents' kept words ``(id, units)`` and their vectors, one row a document."""
    model, units = V.fit_tfidf_units(doc_tokens(t), "doc_id", "tokens_str", MIN_DF, MAX_DF, MAX_FEATURES)
    return model, units, model.rows.vectors(units, "units", ["id"])


def query_docs(t: Tables, n: int = 50):
    return R.sample_n(t.documents.select("doc_id"), n, "doc_id")


def _round(df, c="score", d=6):
    return df.withColumn(c, F.round(c, d))


# ---------------------------------------------------------------------------
# SQL side: token strings -> grams -> vocabulary -> weights
# ---------------------------------------------------------------------------
def _tokens_cte(src: str, id_expr: str, name: str) -> str:
    return (Q.clean_cte(src, f"{id_expr} AS id", "text", "embeddings", name=f"{name}_c") +
            f",\n{name} AS (SELECT id, array_to_string("
            f"{Q.lemmatize(Q.remove_stopwords(Q.tokenize('text_clean')))}, ' ') AS ts FROM {name}_c)")


def _grams_cte(src: str, name: str) -> str:
    return (f"{name}_u AS (SELECT id, regexp_extract_all(lower(ts), {Q.lit(X.TERM_RE)}) AS u FROM {src}),\n"
            f"{name}_g AS (SELECT id, unnest(u) AS term FROM {name}_u UNION ALL SELECT id, "
            f"unnest(list_transform(range(1, len(u)), lambda i: u[i] || ' ' || u[i + 1])) FROM {name}_u),\n"
            f"{name} AS (SELECT id, term, count(*) AS tf FROM {name}_g GROUP BY id, term)")


def _model_cte(tf: str, ndocs_sql: str) -> str:
    return (f"nd AS (SELECT ({ndocs_sql}) AS n),\n"
            f"st AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM {tf} GROUP BY term),\n"
            f"vocab AS (SELECT term, df, cf FROM st WHERE df >= {MIN_DF} AND df <= {MAX_DF} * (SELECT n FROM nd)"
            f" ORDER BY cf DESC, term LIMIT {MAX_FEATURES}),\n"
            f"idf AS (SELECT term, ln((1 + (SELECT n FROM nd)) / (1 + df)) + 1 AS idf FROM vocab)")


def _weights_cte(tf: str, name: str) -> str:
    return (f"{name}_w AS (SELECT id, term, (1 + ln(tf)) * idf AS w FROM {tf} JOIN idf USING (term)),\n"
            f"{name}_n AS (SELECT id, sqrt(sum(w * w)) AS nn FROM {name}_w GROUP BY id),\n"
            f"{name} AS (SELECT id, term, w / nn AS weight FROM {name}_w JOIN {name}_n USING (id))")


DOC_MODEL_SQL = ",\n".join([_tokens_cte("documents", "doc_id", "dt"), _grams_cte("dt", "dtf"),
                            _model_cte("dtf", "SELECT count(*) FROM documents"), _weights_cte("dtf", "dw")])
ALL_DOCS_SQL = "SELECT doc_id FROM documents"
QDOCS_SQL = f"SELECT doc_id FROM documents ORDER BY {Q.md5key('doc_id')}, doc_id LIMIT 50"


def _topk_sql(scores: str, k: int) -> str:
    return (f"SELECT qid, cid, rank, score FROM (SELECT qid, cid, score, row_number() OVER "
            f"(PARTITION BY qid ORDER BY score DESC, cid) AS rank FROM {scores}) WHERE rank <= {k}")


def _all_pairs_sql(qw: str, cw: str, queries: str, cands: str, exclude_self: bool) -> str:
    """Scores of all pairs of (queries, cands), SQL for tables of ids; 0 without a common term."""
    cond = "WHERE qid <> cid" if exclude_self else ""
    return (f"(SELECT qid, cid, coalesce(score, 0.0) AS score FROM (SELECT qid, cid FROM ({queries}) x(qid), ({cands}) y(cid) {cond}) p "
            f"LEFT JOIN {_pairs_sql(qw, cw, exclude_self)} s USING (qid, cid))")


def _pairs_sql(qw: str, cw: str, exclude_self: bool) -> str:
    cond = "WHERE q.id <> c.id" if exclude_self else ""
    return (f"(SELECT q.id AS qid, c.id AS cid, round(sum(q.weight * c.weight), 6) AS score "
            f"FROM {qw} q JOIN {cw} c USING (term) {cond} GROUP BY q.id, c.id)")


# ---------------------------------------------------------------------------
# F1-F5
# ---------------------------------------------------------------------------
@query("ngrams_1_2", f"""WITH {_tokens_cte("documents", "doc_id", "dt")}, {_grams_cte("dt", "dtf")}
SELECT id AS doc_id, term, tf FROM dtf""")
def q_ngrams(spark, d):
    tf = V.term_counts(doc_tokens(Tables(spark, d)), "doc_id", "tokens_str")
    return tf.select(F.col("id").alias("doc_id"), "term", "tf")


@query("build_vocabulary", f"WITH {DOC_MODEL_SQL} SELECT term, df, CAST(cf AS BIGINT) AS cf FROM vocab")
def q_vocab(spark, d):
    vocab = V.text_vocabulary(doc_tokens(Tables(spark, d)), "doc_id", "tokens_str", MIN_DF, MAX_DF, MAX_FEATURES)
    return vocab.select(
        "term", "df", F.col("cf").cast("long").alias("cf"))


@query("tfidf_weights", f"WITH {DOC_MODEL_SQL} SELECT id AS doc_id, term, round(weight, 6) AS weight FROM dw")
def q_tfidf(spark, d):
    _, w = doc_model(Tables(spark, d))
    return w.select(F.col("id").alias("doc_id"), "term", F.round("weight", 6).alias("weight"))


BENCH_W_SQL = ",\n".join([DOC_MODEL_SQL, _tokens_cte("benchmark", "item_id", "bt"),
                          _grams_cte("bt", "btf"), _weights_cte("btf", "bw")])


@query("tfidf_transform", f"WITH {BENCH_W_SQL} SELECT id AS item_id, term, round(weight, 6) AS weight FROM bw")
def q_tfidf_transform(spark, d):
    t = Tables(spark, d)
    model, _ = doc_model(t)
    w = model.transform(bench_tokens(t), "doc_id", "tokens_str")
    return w.select(F.col("id").alias("item_id"), "term", F.round("weight", 6).alias("weight"))


JOINT_SQL = ",\n".join([
    _tokens_cte("(SELECT doc_id AS k, text FROM documents UNION ALL SELECT -1 - item_id, text FROM benchmark)",
                "k", "jt"),
    _grams_cte("jt", "jtf"),
    _model_cte("jtf", "SELECT (SELECT count(*) FROM documents) + (SELECT count(*) FROM benchmark)"),
    _weights_cte("jtf", "jw")])


@query("fit_joint_corpus", f"WITH {JOINT_SQL} SELECT id, term, round(weight, 6) AS weight FROM jw")
def q_joint(spark, d):
    t = Tables(spark, d)
    bench = bench_tokens(t).select((F.lit(-1) - F.col("doc_id")).alias("doc_id"), "tokens_str")
    _, w = V.fit_joint_corpus(doc_tokens(t), bench, "doc_id", "tokens_str",
                              min_df=MIN_DF, max_df=MAX_DF, max_features=MAX_FEATURES)
    return w.select("id", "term", F.round("weight", 6).alias("weight"))


# ---------------------------------------------------------------------------
# G1, G3-G8 sparse recommendation
# ---------------------------------------------------------------------------
@query("cosine_sparse", f"WITH {BENCH_W_SQL} SELECT * FROM {_pairs_sql('bw', 'dw', False)}")
def q_cosine_sparse(spark, d):
    t = Tables(spark, d)
    model, w = doc_model(t)
    qw = model.transform(bench_tokens(t), "doc_id", "tokens_str")
    return _round(V.cosine_sparse(qw, w))


@query("recommend_by_id", f"""WITH {DOC_MODEL_SQL},
qw AS (SELECT * FROM dw WHERE id = 7)
{_topk_sql(_all_pairs_sql('qw', 'dw', 'SELECT 7', ALL_DOCS_SQL, True), K)}""")
def q_rec_by_id(spark, d):
    t = Tables(spark, d)
    profile = V.require_id(t.documents.select("doc_id"), "doc_id", 7)
    model, units, w = doc_vectors(t)
    return V.sparse_topk(model.rows.vectors(units.filter(F.col("id") == 7), "units", ["id"]), w, K, True, (profile, "doc_id"), (t.documents, "doc_id"))


@query("recommend_by_text", f"WITH {BENCH_W_SQL} "
       f"{_topk_sql(_all_pairs_sql('bw', 'dw', 'SELECT item_id FROM benchmark', ALL_DOCS_SQL, False), K)}")
def q_rec_by_text(spark, d):
    t = Tables(spark, d)
    model, _, w = doc_vectors(t)
    qw = model.vectors(bench_tokens(t), "doc_id", "tokens_str")
    return V.sparse_topk(qw, w, K, False, (t.benchmark, "item_id"), (t.documents, "doc_id"))


BATCH_SQL = f"""{DOC_MODEL_SQL},
qw AS (SELECT * FROM dw WHERE id IN ({QDOCS_SQL})),
recs AS ({_topk_sql(_all_pairs_sql('qw', 'dw', QDOCS_SQL, ALL_DOCS_SQL, True), K)})"""


def batch_recs(t: Tables):
    model, units, w = doc_vectors(t)
    qids = query_docs(t).select(F.col("doc_id").alias("id"))
    qw = model.rows.vectors(units.join(qids, "id", "left_semi"), "units", ["id"])
    return V.sparse_topk(qw, w, K, True, (qids, "id"), (t.documents, "doc_id"))


@query("recommend_batch", f"WITH {BATCH_SQL} SELECT * FROM recs")
def q_rec_batch(spark, d):
    return batch_recs(Tables(spark, d))


@query("format_recommendations", f"""WITH {BATCH_SQL}
SELECT r.qid AS query_id, r.rank, round(r.score, 4) AS similarity_score, r.cid AS profile_id,
  d.lang, d.source,
  CASE WHEN length(trim({Q.rx("coalesce(d.text, '')", '[' + Q.SP + ']+', ' ')})) <= 220
       THEN trim({Q.rx("coalesce(d.text, '')", '[' + Q.SP + ']+', ' ')})
       ELSE {Q.rx("substr(trim(" + Q.rx("coalesce(d.text, '')", '[' + Q.SP + ']+', ' ') + "), 1, 220)",
                  '[' + Q.SP + ']+$', '')} || '...' END AS bio_preview
FROM recs r JOIN documents d ON r.cid = d.doc_id""")
def q_format(spark, d):
    t = Tables(spark, d)
    return RM.format_recommendations(batch_recs(t), t.documents, "doc_id",
                                     ["lang", "source", "missing_column"], "text")


RANDOM_SQL = f"""perm AS (SELECT doc_id, row_number() OVER (ORDER BY {Q.md5key('doc_id')}, doc_id) - 1 AS pos
                 FROM documents),
rnd AS (SELECT q.doc_id AS qid, c.doc_id AS cid, j.rank
        FROM perm q JOIN ({QDOCS_SQL}) s ON q.doc_id = s.doc_id
        CROSS JOIN (SELECT unnest(range(1, {K + 1})) AS rank) j
        CROSS JOIN (SELECT count(*) - 1 AS m FROM documents) t
        JOIN perm c ON c.pos = (q.pos + (CAST('0x' || substr(md5('draw:' || q.doc_id), 1, 7) AS BIGINT) % m
          + (j.rank - 1) * (CAST('0x' || substr(md5('draw:' || q.doc_id), 8, 7) AS BIGINT) % (m // least({K}, m)) + 1)) % m + 1) % (m + 1))"""


def random_recs(t: Tables):
    return RM.random_baseline(query_docs(t), t.documents.select("doc_id"), "doc_id", K)


@query("random_baseline", f"WITH {RANDOM_SQL} SELECT qid, cid, rank FROM rnd")
def q_random(spark, d):
    return random_recs(Tables(spark, d))


def dense_recs(t: Tables):
    """The dense method: documents by the whole vector that the embeddings table has under their id."""
    e = t.embeddings.select("vec_id", V.l2_normalize("embedding").alias("vec"))
    qids = query_docs(t).select(F.col("doc_id").alias("vec_id"))
    return V.dense_topk(e.join(qids, "vec_id", "left_semi"), "vec_id", "vec", e, "vec_id", "vec", K, exclude_self=True)


def all_recs(t: Tables):
    return RM.compare_methods({"tfidf": batch_recs(t), "dense": dense_recs(t), "random": random_recs(t)})


def _norm_sql(e: str) -> str:
    return (f"list_transform(CAST({e} AS DOUBLE[]), lambda x: x / sqrt(list_sum(list_transform("
            f"CAST({e} AS DOUBLE[]), lambda y: y * y))))")


DENSE_RECS_SQL = f"""dv AS (SELECT vec_id, {_norm_sql('embedding')} AS vec FROM embeddings),
dpairs AS (SELECT a.vec_id AS qid, b.vec_id AS cid, round(list_dot_product(a.vec, b.vec), 6) AS score
           FROM dv a, dv b WHERE a.vec_id <> b.vec_id AND a.vec_id IN ({QDOCS_SQL})),
drecs AS ({_topk_sql('dpairs', K)})"""


@query("compare_methods", f"""WITH {BATCH_SQL}, {DENSE_RECS_SQL}, {RANDOM_SQL}
SELECT 'tfidf' AS method, qid, cid, rank FROM recs UNION ALL SELECT 'dense', qid, cid, rank FROM drecs
UNION ALL SELECT 'random', qid, cid, rank FROM rnd""")
def q_compare(spark, d):
    return all_recs(Tables(spark, d))


def profiles(t: Tables):
    """Profile attributes for documents: language, source, customer segment,
    nation (as city), balance (as age)."""
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return t.documents.select("doc_id", "lang", "source").join(
        c.select(F.col("c_custkey").alias("doc_id"), "c_mktsegment", "n_name",
                 (F.col("c_acctbal") / 100).alias("age")), "doc_id", "left") \
        .withColumn("location", F.concat_ws(", ", "n_name", "lang"))


_NC = lambda e: f"lower({Q.rx('coalesce(CAST(' + e + ' AS VARCHAR), ' + chr(39) + chr(39) + ')', '^[' + Q.SP + ']+|[' + Q.SP + ']+$', '')})"

DETAILS_SQL = f"""{BATCH_SQL}, {DENSE_RECS_SQL}, {RANDOM_SQL},
allrec AS (SELECT 'tfidf' AS method, qid, cid FROM recs UNION ALL SELECT 'dense', qid, cid FROM drecs UNION ALL SELECT 'random', qid, cid FROM rnd),
prof AS (SELECT d.doc_id, {_NC('d.lang')} AS lang, {_NC('d.source')} AS source, {_NC('c.c_mktsegment')} AS segment,
         {Q.rx("split_part(" + _NC("concat_ws(', ', n.n_name, d.lang)") + ", ',', 1)", '^[' + Q.SP + ']+|[' + Q.SP + ']+$', '')} AS city,
         TRY_CAST(CAST(c.c_acctbal / 100 AS VARCHAR) AS DOUBLE) AS age
         FROM documents d LEFT JOIN customer c ON d.doc_id = c.c_custkey
         LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
details AS (SELECT a.method, a.qid,
  avg(CASE WHEN q.lang <> '' AND c.lang <> '' THEN CAST(q.lang = c.lang AS DOUBLE) END) AS same_lang_at_k,
  avg(CASE WHEN q.source <> '' AND c.source <> '' THEN CAST(q.source = c.source AS DOUBLE) END) AS same_source_at_k,
  avg(CASE WHEN q.segment <> '' AND c.segment <> '' THEN CAST(q.segment = c.segment AS DOUBLE) END) AS same_segment_at_k,
  avg(CASE WHEN q.city <> '' AND c.city <> '' THEN CAST(q.city = c.city AS DOUBLE) END) AS same_city_at_k,
  avg(abs(c.age - q.age)) AS avg_age_diff, {K} AS top_k
  FROM allrec a JOIN prof q ON a.qid = q.doc_id JOIN prof c ON a.cid = c.doc_id GROUP BY a.method, a.qid)"""


def details(t: Tables):
    return RM.metadata_metrics(all_recs(t), profiles(t), "doc_id",
                               {"lang": "lang", "source": "source", "segment": "c_mktsegment"},
                               city_col="location", age_col="age", top_k=K)


@query("metadata_metrics", f"""WITH {DETAILS_SQL}
SELECT method, qid, round(same_lang_at_k, 6) AS same_lang_at_k, round(same_source_at_k, 6) AS same_source_at_k,
  round(same_segment_at_k, 6) AS same_segment_at_k, round(same_city_at_k, 6) AS same_city_at_k,
  round(avg_age_diff, 6) AS avg_age_diff, top_k FROM details""")
def q_details(spark, d):
    df = details(Tables(spark, d))
    for c in ("same_lang_at_k", "same_source_at_k", "same_segment_at_k", "same_city_at_k", "avg_age_diff"):
        df = df.withColumn(c, F.round(c, 6))
    return df


@query("summarize_eval", f"""WITH {DETAILS_SQL}
SELECT method, count(DISTINCT qid) AS n_queries, max(top_k) AS top_k,
  round(avg(same_lang_at_k), 6) AS same_lang_at_k, round(avg(same_source_at_k), 6) AS same_source_at_k,
  round(avg(same_segment_at_k), 6) AS same_segment_at_k, round(avg(same_city_at_k), 6) AS same_city_at_k,
  round(avg(avg_age_diff), 6) AS avg_age_diff FROM details GROUP BY method""")
def q_summary_eval(spark, d):
    return RM.summarize_eval(details(Tables(spark, d)))


# ---------------------------------------------------------------------------
# F6, G2 dense; G15-G20 retrieval on the embeddings table
# ---------------------------------------------------------------------------
@query("load_embeddings", f"""
SELECT vec_id, list_transform({_norm_sql('embedding')}, lambda x: round(x, 6)) AS vec FROM embeddings""")
def q_load_emb(spark, d):
    e = Tables(spark, d).embeddings
    return e.select("vec_id", F.transform(V.l2_normalize("embedding"), lambda x: F.round(x, 6)).alias("vec"))


@query("cosine_dense", f"""
WITH v AS (SELECT vec_id, {_norm_sql('embedding')} AS vec FROM embeddings),
s AS (SELECT a.vec_id AS qid, b.vec_id AS cid, round(list_dot_product(a.vec, b.vec), 6) AS score
      FROM v a, v b WHERE a.vec_id <> b.vec_id)
{_topk_sql('s', K)}""")
def q_cosine_dense(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", V.l2_normalize("embedding").alias("vec"))
    return V.dense_topk(e, "vec_id", "vec", e, "vec_id", "vec", K, exclude_self=True).select(
        "qid", "cid", "rank", "score")


def retrieval_sides(t: Tables):
    """Bank = 80 % per label (seeded), queries = the rest. Every item has a vector and, under the same id, a text."""
    e = t.embeddings.select("vec_id", "label", "embedding")
    s = SP.stratified_split(e, "label", "vec_id", train_pct=80)
    s = written_table(s.select("vec_id", "split", V.l2_normalize("embedding").alias("full")), "sides")
    return s.filter(F.col("split") != "train"), s.filter(F.col("split") == "train")


def retrieval_weights(t: Tables):
    """TF-IDF weights (id, idx, weight) of the items' texts, fitted on queries and bank together."""
    items = t.embeddings.select(F.col("vec_id").alias("doc_id"))
    own = t.documents.select("doc_id", "text").join(items, "doc_id", "left_semi")  # only the items' texts are shuffled
    texts = items.join(own, "doc_id", "left")
    tokens = texts.select("doc_id", TK.tokens_str(TK.token_chain("text", cleaner="embeddings")).alias("tokens_str"))
    model, units = V.fit_tfidf_units(tokens, "doc_id", "tokens_str", MIN_DF, MAX_DF, MAX_FEATURES)
    return model.rows.vectors(units, "units", ["id"])


SIDES_SQL = f"""sp AS ({_split_sql("embeddings", "vec_id", "label", "vec_id, embedding", 80)}),
v AS (SELECT vec_id, split, {_norm_sql('embedding')} AS full FROM sp),
qs AS (SELECT * FROM v WHERE split <> 'train'), bk AS (SELECT * FROM v WHERE split = 'train')"""
RET_SQL = f"""{SIDES_SQL},
pairs AS (SELECT q.vec_id AS qid, b.vec_id AS cid, round(list_dot_product(q.full, b.full), 6) AS s_dense,
   round(list_dot_product(q.full, b.full), 6) AS rel_score FROM qs q, bk b)"""
BOTH_SQL = ",\n".join([
    _tokens_cte("(SELECT e.vec_id, d.text FROM embeddings e LEFT JOIN documents d ON e.vec_id = d.doc_id)", "vec_id", "rt"),
    _grams_cte("rt", "rtf"), _model_cte("rtf", "SELECT count(*) FROM embeddings"), _weights_cte("rtf", "rw"), SIDES_SQL,
    "rwq AS (SELECT * FROM rw WHERE id IN (SELECT vec_id FROM qs))", "rwb AS (SELECT * FROM rw WHERE id IN (SELECT vec_id FROM bk))",
    f"sparse AS {_pairs_sql('rwq', 'rwb', False)}",
    """pairs AS (SELECT q.vec_id AS qid, b.vec_id AS cid, round(list_dot_product(q.full, b.full), 6) AS s_dense,
   coalesce(p.score, 0.0) AS s_tfidf, round(list_dot_product(q.full, b.full), 6) AS rel_score
   FROM qs q CROSS JOIN bk b LEFT JOIN sparse p ON p.qid = q.vec_id AND p.cid = b.vec_id)"""])


def _per_query_sql(m: str) -> str:
    return f"""r_{m} AS (SELECT qid, cid, rel_score >= {REL_T} AS rel,
   row_number() OVER (PARTITION BY qid ORDER BY s_{m} DESC, cid) AS rank FROM pairs),
pq_{m} AS (SELECT qid, CAST(sum(CAST(rel AS INTEGER)) AS BIGINT) AS n_relevant,
   sum(CASE WHEN rel AND rank <= 1 THEN 1 ELSE 0 END) / 1.0 AS p_at_1,
   sum(CASE WHEN rel AND rank <= 3 THEN 1 ELSE 0 END) / 3.0 AS p_at_3,
   sum(CASE WHEN rel AND rank <= 5 THEN 1 ELSE 0 END) / 5.0 AS p_at_5,
   sum(CASE WHEN rel AND rank <= 1 THEN 1 ELSE 0 END) / greatest(sum(CAST(rel AS INTEGER)), 1) AS r_at_1,
   sum(CASE WHEN rel AND rank <= 3 THEN 1 ELSE 0 END) / greatest(sum(CAST(rel AS INTEGER)), 1) AS r_at_3,
   sum(CASE WHEN rel AND rank <= 5 THEN 1 ELSE 0 END) / greatest(sum(CAST(rel AS INTEGER)), 1) AS r_at_5,
   coalesce(1.0 / min(CASE WHEN rel THEN rank END), 0.0) AS rr FROM r_{m} GROUP BY qid)"""


def per_query(t: Tables):
    """(method, per-query metrics) of both methods, as one table: the queries' items against the bank's."""
    qs, bank = retrieval_sides(t)
    w = retrieval_weights(t)
    dense = RT.per_query_metrics(qs, bank, "vec_id", "full", "full", REL_T)
    sparse = RT.per_query_metrics_sparse(qs, bank, "vec_id", "full", w, REL_T)
    return {"dense": dense, "tfidf": sparse}


def _pq_cols(cols: str) -> str:
    return (f"WITH {BOTH_SQL}, {_per_query_sql('dense')}, {_per_query_sql('tfidf')} SELECT 'dense' AS method, qid, {cols} FROM pq_dense "
            f"UNION ALL SELECT 'tfidf', qid, {cols} FROM pq_tfidf")


def _pq_query(t: Tables, *cols):
    d, s = (m.select(F.lit(name).alias("method"), "qid", *cols) for name, m in per_query(t).items())
    return d.unionByName(s)


@query("precision_at_k", _pq_cols("round(p_at_1, 6) AS p_at_1, round(p_at_3, 6) AS p_at_3, round(p_at_5, 6) AS p_at_5"))
def q_precision(spark, d):
    return _pq_query(Tables(spark, d), *[F.round(f"p_at_{k}", 6).alias(f"p_at_{k}") for k in X.K_VALUES])


@query("recall_at_k", _pq_cols("n_relevant, round(r_at_1, 6) AS r_at_1, round(r_at_3, 6) AS r_at_3, "
                               "round(r_at_5, 6) AS r_at_5"))
def q_recall(spark, d):
    return _pq_query(Tables(spark, d), "n_relevant", *[F.round(f"r_at_{k}", 6).alias(f"r_at_{k}") for k in X.K_VALUES])


@query("mrr", _pq_cols("round(rr, 6) AS rr"))
def q_mrr(spark, d):
    return _pq_query(Tables(spark, d), F.round("rr", 6).alias("rr"))


@query("oracle_relevance", f"""WITH {RET_SQL}
SELECT qid, cid, rel_score FROM pairs WHERE rel_score >= {REL_T}""")
def q_relevance(spark, d):
    qs, bank = retrieval_sides(Tables(spark, d))
    return RT.oracle_relevance(qs, bank, "vec_id", "full", REL_T)


def _summary_sql(m: str) -> str:
    return (f"SELECT '{m}' AS method, count(*) AS n_queries, round(avg(p_at_1), 6) AS p_at_1, "
            f"round(avg(p_at_3), 6) AS p_at_3, round(avg(p_at_5), 6) AS p_at_5, round(avg(r_at_1), 6) AS r_at_1, "
            f"round(avg(r_at_3), 6) AS r_at_3, round(avg(r_at_5), 6) AS r_at_5, round(avg(rr), 6) AS mrr, "
            f"round(avg(n_relevant), 6) AS mean_relevant FROM pq_{m}")


@query("retrieval_report", f"""WITH {BOTH_SQL}, {_per_query_sql('dense')}, {_per_query_sql('tfidf')},
s AS ({_summary_sql('dense')} UNION ALL {_summary_sql('tfidf')}),
r AS (SELECT *, row_number() OVER (ORDER BY mrr DESC, method) AS rk FROM s),
x AS (SELECT max(CASE WHEN rk = 2 THEN mrr END) AS second, max(CASE WHEN rk = 1 THEN method END) AS winner FROM r)
SELECT s.*, x.winner, round(s.mrr - x.second, 6) AS mrr_lift,
  round((s.mrr - x.second) * 100.0 / CASE WHEN x.second <> 0 THEN x.second END, 6) AS mrr_lift_pct
FROM s, x""")
def q_report(spark, d):
    dense, sparse = (RT.summarize(m, name) for name, m in per_query(Tables(spark, d)).items())
    return RT.retrieval_report(dense.unionByName(sparse))


@query("retrieval_examples", f"""WITH {RET_SQL},
r AS (SELECT qid, cid, s_dense AS score, rel_score,
      row_number() OVER (PARTITION BY qid ORDER BY s_dense DESC, cid) AS rank FROM pairs)
SELECT qid, rank, cid, score, rel_score FROM r WHERE rank <= 3""")
def q_examples(spark, d):
    qs, bank = retrieval_sides(Tables(spark, d))
    top = V.dense_topk(qs, "vec_id", "full", bank, "vec_id", "full", 3)
    qv = qs.select(F.col("vec_id").alias("qid"), F.col("full").alias("__q"))
    cv = bank.select(F.col("vec_id").alias("cid"), F.col("full").alias("__c"))
    return (top.join(qv, "qid").join(cv, "cid")
            .select("qid", "rank", "cid", "score", F.round(V.dot("__q", "__c"), 6).alias("rel_score")))
