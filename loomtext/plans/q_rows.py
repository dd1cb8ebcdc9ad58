"""Registered queries: filters, dedup, sampling, ids, splits, statistics."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import scalars as S
from ..functions import text as TX
from ..functions import tokens as TK
from ..operators import rows as R
from ..operators import splits as SP
from ..operators import stats as ST
from ..sources.tables import Tables
from . import sqlgen as Q
from .registry import query

MD5_DOC = Q.md5key("doc_id")


def _split_sql(src: str, key: str, label: str | None, cols: str, train_pct: int = 70) -> str:
    part = f"PARTITION BY {label}" if label else ""
    return f"""
WITH k AS (SELECT *, {Q.md5key(key)} AS __k FROM {src}),
r AS (SELECT *, row_number() OVER ({part} ORDER BY __k, {key}) AS __pos,
             count(*) OVER ({part}) AS __n FROM k),
c AS (SELECT *, CAST(floor(__n * {train_pct} / 100) AS BIGINT) AS __tr FROM r),
c2 AS (SELECT *, (__n - __tr) - CAST(ceil((__n - __tr) / 2) AS BIGINT) AS __va FROM c)
SELECT {cols}, CASE WHEN __pos <= __tr THEN 'train' WHEN __pos <= __tr + __va THEN 'val'
       ELSE 'test' END AS split FROM c2"""


# ---------------------------------------------------------------------------
# C1-C4 filters
# ---------------------------------------------------------------------------
@query("drop_null_text", "SELECT doc_id FROM documents WHERE text IS NOT NULL")
def q_drop_null(spark, d):
    return R.drop_null_text(Tables(spark, d).documents.select("doc_id", "text")).select("doc_id")


@query("drop_blank", f"SELECT doc_id FROM documents WHERE NOT {Q.blank('text')}")
def q_drop_blank(spark, d):
    return R.drop_blank(Tables(spark, d).documents.select("doc_id", "text")).select("doc_id")


@query("min_length_filter", f"""
WITH {Q.clean_cte("documents", "doc_id, text", "text", "embeddings")}
SELECT doc_id FROM cleaned WHERE length(text) > 50 AND
  len(list_filter(regexp_split_to_array(text_clean, {Q.lit('[' + Q.SP + ']+')}), lambda w: w <> '')) >= 8""")
def q_min_length(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "text")
    raw = R.min_length_filter(docs, "text", min_chars=50)
    clean = raw.withColumn("text_clean", TX.clean_for_embeddings("text"))
    return R.min_length_filter(clean, "text_clean", min_chars=None, min_words=8).select("doc_id")


@query("language_filter", "SELECT doc_id, lang FROM documents WHERE lang IN ('en')")
def q_lang_filter(spark, d):
    return R.language_filter(Tables(spark, d).documents.select("doc_id", "lang"))


# ---------------------------------------------------------------------------
# C6-C9, C13 union, sampling, ids
# ---------------------------------------------------------------------------
@query("union_sources", """
SELECT 'documents' AS source, 0 AS source_rank, CAST(doc_id AS VARCHAR) AS id, text FROM documents
UNION ALL SELECT 'benchmark', 1, CAST(item_id AS VARCHAR), text FROM benchmark
UNION ALL SELECT 'conversations', 2, CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR), text
FROM conversations""")
def q_union(spark, d):
    t = Tables(spark, d)
    docs = t.documents.select(F.col("doc_id").cast("string").alias("id"), "text")
    bench = t.benchmark.select(F.col("item_id").cast("string").alias("id"), "text")
    conv = t.conversations.select(F.concat_ws(":", "conv_id", "turn").alias("id"), "text")
    out = R.union_sources([("documents", docs), ("benchmark", bench), ("conversations", conv)])
    return out.select("source", "source_rank", "id", "text")


@query("sample_n", f"SELECT doc_id FROM documents ORDER BY {MD5_DOC}, doc_id LIMIT 100")
def q_sample(spark, d):
    return R.sample_n(Tables(spark, d).documents.select("doc_id"), 100, "doc_id")


@query("query_sample", f"SELECT c_custkey FROM customer ORDER BY {Q.md5key('c_custkey')}, c_custkey LIMIT 50")
def q_query_sample(spark, d):
    return SP.query_sample(Tables(spark, d).customer.select("c_custkey"), 50, "c_custkey")


@query("shuffle_rows", f"""
SELECT doc_id, row_number() OVER (ORDER BY {MD5_DOC}, doc_id) - 1 AS row_id FROM documents""")
def q_shuffle(spark, d):
    docs = Tables(spark, d).documents.select("doc_id").withColumn("__k", R.seeded_key("doc_id"))
    return R.assign_row_id(docs, ["__k", "doc_id"], digest=True).select("doc_id", "row_id")


@query("assign_row_id", """
SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_id FROM conversations""")
def q_row_id(spark, d):
    c = Tables(spark, d).conversations.select("conv_id", "turn")
    return R.assign_row_id(c, ["conv_id", "turn"])


@query("assert_unique_sequential", """
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM documents)
SELECT count(*) AS n, count(DISTINCT row_id) AS n_ids, min(row_id) AS min_id, max(row_id) AS max_id,
  (count(*) = count(DISTINCT row_id) AND min(row_id) = 0 AND max(row_id) = count(*) - 1) AS ok FROM r""")
def q_unique_seq(spark, d):
    ids = R.assign_row_id(Tables(spark, d).documents.select("doc_id"), ["doc_id"])
    return R.assert_unique_sequential(ids, "row_id")


@query("detect_layout", f"""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 AND text IS NOT NULL THEN 'structured'
    WHEN doc_id % 3 = 1 AND regexp_matches('7 your persona: ' || text, {Q.lit(X.PERSONA_FACT_RE)}) THEN 'text'
    WHEN regexp_matches(text, {Q.lit(X.PERSONA_FACT_RE)}) THEN 'text' ELSE 'unknown' END AS kind,
  CASE WHEN doc_id % 3 = 0 AND text IS NOT NULL THEN 'personality'
    WHEN doc_id % 3 = 1 AND regexp_matches('7 your persona: ' || text, {Q.lit(X.PERSONA_FACT_RE)}) THEN 'text'
    WHEN regexp_matches(text, {Q.lit(X.PERSONA_FACT_RE)}) THEN 'text' END AS field
FROM documents""")
def q_detect_layout(spark, d):
    # three shapes of record: a list of facts, a persona line, plain text
    docs = Tables(spark, d).documents
    line = F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit("7 your persona: "), "text")).otherwise(F.col("text"))
    facts = F.when(F.col("doc_id") % 3 == 0, F.split("text", "\\n"))
    shaped = docs.select("doc_id", facts.alias("personality"), line.alias("text"))
    return shaped.select("doc_id", R.record_layout(shaped).alias("l")).select("doc_id", "l.kind", "l.field")


@query("diverse_sample", f"""
WITH r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY {Q.md5key('vec_id')}, vec_id)
           AS round FROM embeddings)
SELECT vec_id, label, round FROM r ORDER BY round, {Q.md5key('label')}, label LIMIT 100""")
def q_diverse(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", "label")
    return R.diverse_sample(e, "label", "vec_id", 100).select("vec_id", "label", "round")


# ---------------------------------------------------------------------------
# C10, C11 persona blocks. A conversation's turns as persona lines: the first
# conversation starts with fact 2 (facts before any start), every third turn
# stays an ordinary line between facts.
# ---------------------------------------------------------------------------
_STRIP = "^[" + Q.SP + "]+|[" + Q.SP + "]+$"
_CHUNKS = ", ".join(f"CAST(sum(('0x' || substr(md5(lower(fact)), {8 * i + 1}, 8))::BIGINT) AS VARCHAR)"
                    for i in range(4))


@query("persona_blocks", f"""
WITH l AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN text
             ELSE ' ' || CAST(turn + CASE WHEN conv_id % 10 = 0 THEN 2 ELSE 1 END AS VARCHAR) || ' your persona: ' || text END AS line
           FROM conversations),
t AS (SELECT *, {Q.rx("coalesce(line, '')", _STRIP, '')} AS s FROM l),
b AS (SELECT *, sum(CASE WHEN regexp_matches(s, {Q.lit(X.PERSONA_START_RE)}) THEN 1 ELSE 0 END) OVER (
        ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS block_no,
      {Q.rx("regexp_extract(s, " + Q.lit(X.PERSONA_FACT_RE) + ", 1)", _STRIP, '')} AS fact FROM t),
f AS (SELECT * FROM b WHERE fact <> ''),
g AS (SELECT block_no, concat_ws(':', CAST(count(*) AS VARCHAR), {_CHUNKS}) AS signature FROM f GROUP BY block_no),
k AS (SELECT min(block_no) AS block_no FROM g GROUP BY signature)
SELECT CAST(f.block_no AS BIGINT) AS block_no, conv_id, turn, fact FROM f JOIN k ON f.block_no = k.block_no""")
def q_blocks(spark, d):
    no = F.col("turn") + F.when(F.col("conv_id") % 10 == 0, 2).otherwise(1)
    line = F.when(F.col("turn") % 3 == 2, F.col("text")).otherwise(
        F.concat(F.lit(" "), no.cast("string"), F.lit(" your persona: "), "text"))
    c = Tables(spark, d).conversations.select("conv_id", "turn", line.alias("line"))
    return R.persona_blocks(c, None, ["conv_id", "turn"], "line")


@query("persona_structured", f"""
WITH g AS (SELECT conv_id AS id, turn, {Q.rx('text', _STRIP, '')} AS fact FROM conversations),
f AS (SELECT * FROM g WHERE fact <> ''),
s AS (SELECT id, concat_ws(':', CAST(count(*) AS VARCHAR), {_CHUNKS}) AS signature FROM f GROUP BY id),
k AS (SELECT signature, min(id) AS id FROM s GROUP BY signature)
SELECT f.id, f.turn, f.fact, k.signature FROM f JOIN k ON f.id = k.id""")
def q_personas(spark, d):
    c = Tables(spark, d).conversations
    return R.persona_structured_long(c, "conv_id", ["turn"], "text")


# ---------------------------------------------------------------------------
# C14-C16 checks
# ---------------------------------------------------------------------------
_DOC_SPLIT = _split_sql("documents", "doc_id", "lang", "doc_id, lang, text")


@query("overlap_between_splits", f"""
WITH s AS ({_DOC_SPLIT}),
u AS (SELECT text, max(CAST(split = 'train' AS INTEGER)) AS i0, max(CAST(split = 'val' AS INTEGER)) AS i1,
             max(CAST(split = 'test' AS INTEGER)) AS i2 FROM s GROUP BY text),
a AS (SELECT CAST(sum(i0) AS BIGINT) AS n0, CAST(sum(i1) AS BIGINT) AS n1,
             CAST(sum(i0 * i1) AS BIGINT) AS o01, CAST(sum(i0 * i2) AS BIGINT) AS o02,
             CAST(sum(i1 * i2) AS BIGINT) AS o12 FROM u),
rws AS (SELECT 'train' AS split_a, 'val' AS split_b, o01 AS overlap, n0 AS n_unique_a FROM a
        UNION ALL SELECT 'train', 'test', o02, n0 FROM a
        UNION ALL SELECT 'val', 'test', o12, n1 FROM a)
SELECT *, round(overlap * 100.0 / greatest(n_unique_a, 1), 4) AS pct FROM rws""")
def q_overlap(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "lang", "text")
    split = SP.stratified_split(docs, "lang", "doc_id")
    return R.overlap_between_splits(split, "split", "text")


@query("assert_disjoint", f"""
WITH s AS ({_split_sql("(SELECT DISTINCT conv_id FROM conversations)", "conv_id", None, "conv_id")})
SELECT CAST(count(*) AS BIGINT) AS n_shared, count(*) = 0 AS ok FROM
  (SELECT conv_id FROM s WHERE split = 'train' INTERSECT SELECT conv_id FROM s WHERE split = 'test')""")
def q_disjoint(spark, d):
    split = SP.group_split(Tables(spark, d).conversations.select("conv_id", "turn"), "conv_id")
    return R.assert_disjoint(split.filter(F.col("split") == "train"),
                             split.filter(F.col("split") == "test"), ["conv_id"])


# ---------------------------------------------------------------------------
# D1-D4 splits and routing
# ---------------------------------------------------------------------------
@query("stratified_split", _split_sql("labels", "doc_id", "toxic", "doc_id, toxic"))
def q_strat(spark, d):
    lab = Tables(spark, d).labels.select("doc_id", "toxic")
    return SP.stratified_split(lab, "toxic", "doc_id")


@query("group_split", f"""
WITH g AS ({_split_sql("(SELECT DISTINCT conv_id FROM conversations)", "conv_id", None, "conv_id")})
SELECT c.conv_id, c.turn, g.split FROM conversations c JOIN g ON c.conv_id = g.conv_id""")
def q_group_split(spark, d):
    c = Tables(spark, d).conversations.select("conv_id", "turn")
    return SP.group_split(c, "conv_id").select("conv_id", "turn", "split")


@query("holdout_by_entity", f"""
WITH e AS (SELECT conv_id FROM (SELECT DISTINCT conv_id FROM conversations)
           ORDER BY {Q.md5key('conv_id')}, conv_id LIMIT 75)
SELECT c.conv_id, c.turn, CASE WHEN e.conv_id IS NOT NULL THEN 'eval' ELSE 'train' END AS split
FROM conversations c LEFT JOIN e ON c.conv_id = e.conv_id""")
def q_holdout(spark, d):
    c = Tables(spark, d).conversations.select("conv_id", "turn")
    return SP.holdout_by_entity(c, "conv_id", 75).select("conv_id", "turn", "split")


@query("route_records", """
SELECT event_id, user_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q_route(spark, d):
    t = Tables(spark, d)
    ids = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("user_id"))
    return SP.route_records(t.events.select("event_id", "user_id"), ids, "user_id")


@query("anti_by_set", """
SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q_anti(spark, d):
    t = Tables(spark, d)
    ids = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("user_id"))
    return SP.route_records(t.events.select("event_id", "user_id"), ids, "user_id", keep=False)


# ---------------------------------------------------------------------------
# E1-E17 statistics
# ---------------------------------------------------------------------------
@query("label_distribution", "SELECT toxic, count(*) AS n FROM labels GROUP BY toxic")
def q_label_dist(spark, d):
    return ST.label_distribution(Tables(spark, d).labels, "toxic")


@query("label_share", """
SELECT quality, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM labels GROUP BY quality""")
def q_label_share(spark, d):
    return ST.label_share(Tables(spark, d).labels, "quality")


@query("split_distribution", f"""
WITH s AS ({_split_sql("labels", "doc_id", "toxic", "doc_id, toxic")}),
g AS (SELECT split, toxic, count(*) AS n FROM s GROUP BY split, toxic)
SELECT split, toxic, n, round(n * 100.0 / sum(n) OVER (PARTITION BY split), 4) AS pct FROM g""")
def q_split_dist(spark, d):
    lab = Tables(spark, d).labels.select("doc_id", "toxic")
    return ST.split_distribution(SP.stratified_split(lab, "toxic", "doc_id"), "split", "toxic")


@query("rating_distribution", """
SELECT CAST(floor(value / 100) AS BIGINT) AS rating, count(*) AS n FROM events GROUP BY 1""")
def q_rating_dist(spark, d):
    e = Tables(spark, d).events.select(F.floor(F.col("value") / 100).cast("long").alias("rating"))
    return ST.rating_distribution(e, "rating")


@query("distinct_counts", """
SELECT count(*) AS n_rows, count(DISTINCT conv_id) AS n_conversations, count(DISTINCT text) AS n_texts,
       count(DISTINCT role) AS n_roles FROM conversations""")
def q_distinct(spark, d):
    c = Tables(spark, d).conversations
    return ST.distinct_counts(c, {"n_conversations": "conv_id", "n_texts": "text", "n_roles": "role"})


@query("unique_by_group", "SELECT role, count(DISTINCT text) AS n_unique FROM conversations GROUP BY role")
def q_unique_by_group(spark, d):
    return ST.unique_by_group(Tables(spark, d).conversations, "role", "text")


@query("dataset_summary", f"""
WITH s AS ({_split_sql("(SELECT DISTINCT conv_id FROM conversations)", "conv_id", None, "conv_id")}),
c AS (SELECT c.*, s.split FROM conversations c JOIN s ON c.conv_id = s.conv_id),
u AS (SELECT text, max(CAST(split = 'train' AS INTEGER)) AS i0, max(CAST(split = 'val' AS INTEGER)) AS i1,
             max(CAST(split = 'test' AS INTEGER)) AS i2 FROM c GROUP BY text)
SELECT 'n_rows' AS metric, CAST(count(*) AS BIGINT) AS value FROM conversations
UNION ALL SELECT 'n_conversations', count(DISTINCT conv_id) FROM conversations
UNION ALL SELECT 'n_texts', count(DISTINCT text) FROM conversations
UNION ALL SELECT 'unique_' || role, count(DISTINCT text) FROM conversations GROUP BY role
UNION ALL SELECT 'overlap_train_val', CAST(sum(i0 * i1) AS BIGINT) FROM u
UNION ALL SELECT 'overlap_train_test', CAST(sum(i0 * i2) AS BIGINT) FROM u
UNION ALL SELECT 'overlap_val_test', CAST(sum(i1 * i2) AS BIGINT) FROM u""")
def q_summary(spark, d):
    c = Tables(spark, d).conversations
    dc = ST.distinct_counts(c, {"n_conversations": "conv_id", "n_texts": "text"})
    head = dc.select(F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).cast("long").alias("value"))
                                        for k in ("n_rows", "n_conversations", "n_texts")])))
    ub = ST.unique_by_group(c, "role", "text").select(
        F.concat(F.lit("unique_"), "role").alias("metric"), F.col("n_unique").cast("long").alias("value"))
    ov = R.overlap_between_splits(SP.group_split(c, "conv_id"), "split", "text").select(
        F.concat(F.lit("overlap_"), "split_a", F.lit("_"), "split_b").alias("metric"),
        F.col("overlap").cast("long").alias("value"))
    return head.unionByName(ub).unionByName(ov)


@query("token_length_stats", f"""
WITH t AS (SELECT {Q.remove_stopwords(Q.tokenize('lower(text)'))} AS tokens FROM documents)
SELECT count(*) AS n_rows, round(avg(len(tokens)), 6) AS avg_token_len,
       CAST(median(len(tokens)) AS DOUBLE) AS median_token_len FROM t""")
def q_token_len(spark, d):
    docs = _docs(spark, d).select(TK.remove_stopwords(TK.tokenize(F.lower("text"))).alias("tokens"))
    return ST.token_length_stats(docs, "tokens")


def _docs(spark, d):
    return Tables(spark, d).documents.select("doc_id", "text")


@query("top_tokens", f"""
WITH t AS (SELECT unnest({Q.remove_stopwords(Q.tokenize('lower(text)'))}) AS token FROM documents)
SELECT token, count(*) AS n FROM t GROUP BY token ORDER BY n DESC, token LIMIT 30""")
def q_top_tokens(spark, d):
    docs = _docs(spark, d).select(TK.remove_stopwords(TK.tokenize(F.lower("text"))).alias("tokens"))
    return ST.top_tokens(docs, "tokens", 30)


_WC_SQL = f"len(list_filter(regexp_split_to_array(coalesce(text, ''), {Q.lit('[' + Q.SP + ']+')}), lambda w: w <> ''))"


@query("histogram", f"""
SELECT CAST(floor((least(greatest({_WC_SQL}, 0), 400) - 0) / 20) AS BIGINT) AS bin, count(*) AS n,
       CAST(CAST(floor((least(greatest({_WC_SQL}, 0), 400) - 0) / 20) AS BIGINT) * 20.0 + 0.0 AS DOUBLE) AS bin_lo
FROM documents GROUP BY 1""")
def q_hist(spark, d):
    docs = _docs(spark, d).withColumn("wc", S.word_count("text"))
    return ST.histogram(docs, "wc", 0.0, 400.0, 20.0)


@query("box_stats", """
SELECT lang, count(*) AS n, quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.5) AS median,
  quantile_cont(n_chars, 0.75) AS q3, min(n_chars) AS min, max(n_chars) AS max,
  greatest(min(n_chars), quantile_cont(n_chars, 0.25) - 1.5 * (quantile_cont(n_chars, 0.75) - quantile_cont(n_chars, 0.25))) AS whisker_lo,
  least(max(n_chars), quantile_cont(n_chars, 0.75) + 1.5 * (quantile_cont(n_chars, 0.75) - quantile_cont(n_chars, 0.25))) AS whisker_hi
FROM documents GROUP BY lang""")
def q_box(spark, d):
    docs = Tables(spark, d).documents.select("lang", "n_chars")
    return ST.box_stats(docs, "n_chars", "lang")


@query("flag_rate_by_label", f"""
SELECT l.toxic, round(avg(CAST(regexp_matches(d.text, {Q.lit(S.X.HAS_PHONE_RE)}) AS INTEGER)), 6) AS has_phone_rate,
       round(avg(CAST(regexp_matches(d.text, {Q.lit(S.X.HAS_MONEY_RE)}) AS INTEGER)), 6) AS has_money_rate
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY l.toxic""")
def q_flag_rate(spark, d):
    t = Tables(spark, d)
    j = t.documents.join(t.labels, "doc_id").select(
        "toxic", F.col("text").rlike(S.X.HAS_PHONE_RE).cast("int").alias("has_phone"),
        F.col("text").rlike(S.X.HAS_MONEY_RE).cast("int").alias("has_money"))
    return ST.flag_rate_by_label(j, "toxic", ["has_phone", "has_money"])


# the tables carry no emotion: a turn's is drawn from the score table's names by its word count
_EMOTIONS = list(S.X.EMOTION_SCORE)
_EMOTION_SQL = "CASE {} % {} {} END".format(_WC_SQL, len(_EMOTIONS), " ".join(
    f"WHEN {i} THEN CAST({S.X.EMOTION_SCORE[e]} AS DOUBLE)" for i, e in enumerate(_EMOTIONS)))


@query("emotion_progression", f"""
SELECT turn, role, round(avg({_EMOTION_SQL}), 6) AS mean_score FROM conversations GROUP BY turn, role""")
def q_progression(spark, d):
    c = Tables(spark, d).conversations
    emotion = F.get(F.array(*[F.lit(e) for e in _EMOTIONS]), (S.word_count("text") % len(_EMOTIONS)).cast("int"))
    return ST.emotion_progression(c, "turn", "role", ST.emotion_score(emotion, S.X.EMOTION_SCORE))


@query("emotion_by_flow", f"""
SELECT turn, round(avg({_EMOTION_SQL}) FILTER (WHERE role = 'user'), 6) AS "user",
       round(avg({_EMOTION_SQL}) FILTER (WHERE role = 'assistant'), 6) AS assistant
FROM conversations GROUP BY turn""")
def q_progression_wide(spark, d):
    c = Tables(spark, d).conversations
    emotion = F.get(F.array(*[F.lit(e) for e in _EMOTIONS]), (S.word_count("text") % len(_EMOTIONS)).cast("int"))
    return ST.emotion_progression(c, "turn", "role", ST.emotion_score(emotion, S.X.EMOTION_SCORE), ["user", "assistant"])


@query("mean_list_size", "SELECT round(avg(len(string_split(text, chr(10)))), 6) AS mean_size FROM conversations")
def q_mean_size(spark, d):
    c = Tables(spark, d).conversations.select(F.split("text", "\n").alias("facts"))
    return ST.mean_list_size(c, "facts")


@query("cost_estimate", """
WITH a AS (SELECT count(*) AS n_measured, avg(value * 10) AS avg_in,
                  avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS avg_out FROM events)
SELECT n_measured, round(avg_in, 6) AS avg_in, round(avg_out, 6) AS avg_out, 1500 AS calls,
  round(1500 * (avg_in * 0.00000015 + avg_out * 0.0000006), 6) AS estimate,
  1500 * (avg_in * 0.00000015 + avg_out * 0.0000006) > 3.0 AS over_budget FROM a""")
def q_cost(spark, d):
    e = Tables(spark, d).events
    return ST.cost_estimate(e, F.col("value") * 10,
                            F.get_json_object("props", "$.k").cast("double"),
                            1500, 0.00000015, 0.0000006, 3.0)


@query("reject_rate", """
SELECT count(*) AS total, CAST(sum(CAST(event_type = 'error' AS INTEGER)) AS BIGINT) AS rejected,
  round(sum(CAST(event_type = 'error' AS INTEGER)) / greatest(count(*), 1), 6) AS reject_rate FROM events""")
def q_reject(spark, d):
    e = Tables(spark, d).events
    return ST.reject_rate(e, F.col("event_type") == "error")
