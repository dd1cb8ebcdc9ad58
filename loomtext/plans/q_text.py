"""Registered queries: flagship slice and text scalar functions (B*)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import scalars as S
from ..functions import text as TX
from ..functions import tokens as TK
from ..operators import rows as R
from ..operators import stats as ST
from ..sources.tables import Tables
from . import sqlgen as Q
from .registry import query


# ---------------------------------------------------------------------------
# Flagship: documents -> drop null -> classification cleaner -> drop blank ->
# dedup keep-first -> join labels -> counts by (source, toxic)
# ---------------------------------------------------------------------------
def _cleaned(t: Tables):
    docs = R.drop_null_text(t.documents.select("doc_id", "text", "source"))
    return docs.select("doc_id", "source", TX.clean_for_classification("text").alias("text_clean"))


def clean_dedup(t: Tables):
    # The cleaner trims, so a blank cleaned text is ''. Blank texts form one
    # group; dropping it inside the dedup (HAVING) keeps exactly the rows of
    # drop-then-dedup while the cleaner is evaluated once.
    return R.dedup_keep_first(_cleaned(t), ["text_clean"], ["doc_id"], drop_empty_key=True)


FLAGSHIP_SQL = f"""
WITH {Q.clean_cte("(SELECT * FROM documents WHERE text IS NOT NULL)", "doc_id, source", "text",
                  "classification")},
nonblank AS (SELECT * FROM cleaned WHERE {Q.blank('text_clean')} = false),
ranked AS (SELECT *, row_number() OVER (PARTITION BY text_clean ORDER BY doc_id) AS rn
           FROM nonblank),
dedup AS (SELECT doc_id, source, text_clean FROM ranked WHERE rn = 1)
SELECT d.source, l.toxic, count(*) AS n
FROM dedup d JOIN labels l ON d.doc_id = l.doc_id
GROUP BY d.source, l.toxic
"""


@query("label_by_source", FLAGSHIP_SQL)
def q_label_by_source(spark, d):
    t = Tables(spark, d)
    # Only ids go on, so texts are cleaned once and never shuffled or sorted.
    first = R.first_ids(_cleaned(t), "text_clean", "doc_id", drop_empty_key=True)
    joined = (t.documents.select("doc_id", "source").join(first, "doc_id", "left_semi")
              .join(t.labels.select("doc_id", "toxic"), "doc_id"))
    return ST.label_by_source(joined, "source", "toxic")


@query("dedup_keep_first", f"""
WITH {Q.clean_cte("(SELECT * FROM documents WHERE text IS NOT NULL)", "doc_id, source", "text",
                  "classification")},
nonblank AS (SELECT * FROM cleaned WHERE {Q.blank('text_clean')} = false),
ranked AS (SELECT *, row_number() OVER (PARTITION BY text_clean ORDER BY doc_id) AS rn
           FROM nonblank)
SELECT doc_id, source, text_clean FROM ranked WHERE rn = 1
""")
def q_dedup(spark, d):
    return clean_dedup(Tables(spark, d)).select("doc_id", "source", "text_clean")


# ---------------------------------------------------------------------------
# Single text functions on documents / pages
# ---------------------------------------------------------------------------
def _docs(spark, d):
    return Tables(spark, d).documents.select("doc_id", "text")


def _doc_query(name, spark_fn, sql_expr, table="documents", id_col="doc_id", src="text"):
    def fn(spark, d):
        df = Tables(spark, d).__getattr__(table).select(id_col, src)
        return df.select(id_col, spark_fn(F.col(src)).alias("out"))
    query(name, f"SELECT {id_col}, {sql_expr} AS out FROM {table}")(fn)


_doc_query("mask_urls", TX.mask_urls, Q.rx("html", X.URL_RE, X.URL_TOKEN),
           table="pages", id_col="page_id", src="html")
_doc_query("mask_emails", TX.mask_emails, Q.rx("text", Q.EMAIL_SQL, X.EMAIL_TOKEN))
_doc_query("mask_phones", TX.mask_phones, Q.rx("text", X.PHONE_RE, X.PHONE_TOKEN))
_doc_query("remove_emojis", TX.remove_emojis,
           Q.rx("text", TX.EMOJI_CLASS + r"\x{FE0F}?", ""))
_doc_query("strip_punct", lambda c: TX.strip_punct(c, X.KEEP_EMBEDDINGS),
           Q.strip_punct("text", X.KEEP_EMBEDDINGS))
_doc_query("mask_numbers", TX.mask_numbers, Q.mask_numbers("text"))
_doc_query("norm_whitespace", TX.norm_whitespace, Q.norm_ws("text"))
_ASCII_SQL = "translate(text, {}, {})".format(Q.lit(TX._latin_table()[0]), Q.lit(TX._latin_table()[1]))
for _letter, _form in X.LATIN_LETTERS:
    if len(_form) > 1:
        _ASCII_SQL = f"replace({_ASCII_SQL}, {Q.lit(_letter)}, {Q.lit(_form)})"
_doc_query("to_ascii", TX.to_ascii, _ASCII_SQL)
_doc_query("strip_nonprintable", TX.strip_nonprintable, Q.rx("text", X.NON_PRINTABLE_RE, ""))
_doc_query("lower_text", TX.lower_text, "lower(text)")
_doc_query("html_entities", TX.unescape_basic_entities,
           "".join("replace(" for _ in TX.HTML_ENTITIES) + "html" + "".join(
               f", {Q.lit(a)}, {Q.lit(b)})" for a, b in TX.HTML_ENTITIES),
           table="pages", id_col="page_id", src="html")
_doc_query("preview", lambda c: S.preview(c, 220),
           "CASE WHEN length(trim({w})) <= 220 THEN trim({w}) ELSE {cut} || '...' END".format(
               w=Q.rx("coalesce(text, '')", "[" + X.SPACE + "]+", " "),
               cut=Q.rx("substr(trim({}), 1, 220)".format(
                   Q.rx("coalesce(text, '')", "[" + X.SPACE + "]+", " ")),
                   "[" + X.SPACE + "]+$", "")))
_doc_query("word_count", lambda c: S.word_count(c).cast("long"),
           "CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), {}), lambda w: w <> '')) AS BIGINT)"
           .format(Q.lit("[" + X.SPACE + "]+")))


# Mentions and hashtags do not occur in the generated prose; the query builds
# them from the row's own columns so the operator sees real cases.
@query("mask_mentions", f"""
SELECT doc_id, {Q.rx("'@' || lang || '_' || source || ' hi @' || source || '! ' || text",
                     X.MENTION_RE, X.USER_TOKEN)} AS out FROM documents""")
def q_mentions(spark, d):
    df = Tables(spark, d).documents
    src = F.concat(F.lit("@"), "lang", F.lit("_"), "source", F.lit(" hi @"), "source",
                   F.lit("! "), "text")
    return df.select("doc_id", TX.mask_mentions(src).alias("out"))


@query("unwrap_hashtags", f"""
SELECT doc_id, {Q.rx("'#' || lang || ' #' || source || ' ' || text", X.HASHTAG_RE, ' \\1 ')} AS out
FROM documents""")
def q_hashtags(spark, d):
    df = Tables(spark, d).documents
    src = F.concat(F.lit("#"), "lang", F.lit(" #"), "source", F.lit(" "), "text")
    return df.select("doc_id", TX.unwrap_hashtags(src).alias("out"))


@query("collapse_repeats", f"""
WITH a AS (SELECT doc_id, string_split(text, '') AS ch FROM documents)
SELECT doc_id, {Q.collapse_list('ch')} AS out FROM a""")
def q_collapse(spark, d):
    return _docs(spark, d).select("doc_id", TX.collapse_repeats("text").alias("out"))


def _cleaner_query(name, kind):
    sql = f"""
WITH {Q.clean_cte("documents", "doc_id", "text", kind)}
SELECT doc_id, text_clean FROM cleaned"""

    def fn(spark, d):
        return _docs(spark, d).select("doc_id", TX.CLEANERS[kind]("text").alias("text_clean"))
    query(name, sql)(fn)


_cleaner_query("clean_for_embeddings", "embeddings")
_cleaner_query("clean_for_classification", "classification")
_cleaner_query("clean_for_sentiment", "sentiment")


# ---------------------------------------------------------------------------
# Tokens
# ---------------------------------------------------------------------------
@query("tokenize", f"SELECT doc_id, {Q.tokenize('lower(text)')} AS tokens FROM documents")
def q_tokenize(spark, d):
    return _docs(spark, d).select("doc_id", TK.tokenize(F.lower("text")).alias("tokens"))


@query("remove_stopwords",
       f"SELECT doc_id, {Q.remove_stopwords(Q.tokenize('text'))} AS tokens FROM documents")
def q_stop(spark, d):
    return _docs(spark, d).select("doc_id", TK.remove_stopwords(TK.tokenize("text")).alias("tokens"))


@query("lemmatize", f"SELECT doc_id, {Q.lemmatize(Q.tokenize('lower(text)'))} AS tokens FROM documents")
def q_lemma(spark, d):
    return _docs(spark, d).select("doc_id", TK.lemmatize(TK.tokenize(F.lower("text"))).alias("tokens"))


FULL_TOKENS_SQL = f"""
WITH {Q.clean_cte("documents", "doc_id", "text", "embeddings")}
SELECT doc_id, array_to_string({Q.lemmatize(Q.remove_stopwords(Q.tokenize('text_clean')))}, ' ')
       AS tokens_str FROM cleaned"""


@query("full_tokens", FULL_TOKENS_SQL)
def q_full_tokens(spark, d):
    toks = TK.token_chain("text", cleaner="embeddings")
    return _docs(spark, d).select("doc_id", TK.tokens_str(toks).alias("tokens_str"))


# ---------------------------------------------------------------------------
# Features and small parsers
# ---------------------------------------------------------------------------
@query("merge_text_columns", """
SELECT p_partkey, regexp_replace(concat_ws(' ', coalesce(p_name, ''), coalesce(p_brand, ''),
       coalesce(CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_type END, ''), coalesce(p_type, '')),
       '^[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+|[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+$', '', 'g') AS merged
FROM part""".replace("\\\\", "\\"))
def q_merge(spark, d):
    p = Tables(spark, d).part
    maybe_null = F.when(F.col("p_size") % 2 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type"))
    return p.select("p_partkey", S.merge_text_columns(["p_name", "p_brand", maybe_null, "p_type"]).alias("merged"))


@query("norm_category", f"""
SELECT c_custkey, lower({Q.rx("coalesce(' ' || c_mktsegment || ' ', '')", '^[' + X.SPACE + ']+|[' + X.SPACE + ']+$', '')})
       AS segment FROM customer""")
def q_norm_category(spark, d):
    c = Tables(spark, d).customer
    return c.select("c_custkey", S.norm_category(F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))).alias("segment"))


_STRIP = '^[' + X.SPACE + ']+|[' + X.SPACE + ']+$'


@query("city_of", f"""
SELECT c.c_custkey,
       {Q.rx("split_part(lower(" + Q.rx("coalesce(n.n_name || ', ' || c.c_mktsegment, '')", _STRIP, '') + "), ',', 1)", _STRIP, '')} AS city
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_city(spark, d):
    t = Tables(spark, d)
    j = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select("c_custkey", S.city_of(F.concat_ws(", ", "n_name", "c_mktsegment")).alias("city"))


@query("scam_features", f"""
WITH {Q.clean_cte("documents", "doc_id, text", "text", "classification")}
SELECT doc_id, CAST(length(text) AS BIGINT) AS len_chars,
  CAST(len(list_filter(regexp_split_to_array(array_to_string({Q.tokenize('text_clean')}, ' '), {Q.lit('[' + X.SPACE + ']+')}), lambda w: w <> '')) AS BIGINT) AS len_tokens,
  CAST(regexp_matches(text, {Q.lit(X.HAS_URL_RE)}) AS INTEGER) AS has_url,
  CAST(regexp_matches(text, {Q.lit(X.HAS_PHONE_RE)}) AS INTEGER) AS has_phone,
  CAST(regexp_matches(text, {Q.lit(X.HAS_MONEY_RE)}) AS INTEGER) AS has_money
FROM cleaned""")
def q_scam_features(spark, d):
    df = _docs(spark, d).withColumn("text_clean", TX.clean_for_classification("text"))
    df = df.withColumn("tokens_str", TK.tokens_str(TK.tokenize("text_clean")))
    len_chars, len_tokens, *flags = S.scam_features("text", "tokens_str")
    return df.select("doc_id", len_chars.cast("long").alias("len_chars"),
                     len_tokens.cast("long").alias("len_tokens"), *flags)


@query("parse_bio", f"""
SELECT conv_id, turn, {Q.rx("split_part(regexp_replace('Bio: I wrote Bio: ' || text, '^Bio: ', ''), chr(10), 1)", _STRIP, '')} AS bio
FROM conversations""")
def q_parse_bio(spark, d):
    c = Tables(spark, d).conversations
    return c.select("conv_id", "turn", S.parse_bio(F.concat(F.lit("Bio: I wrote Bio: "), "text")).alias("bio"))


@query("fact_signature", f"""
SELECT conv_id, turn, list_sort(list_filter(list_transform(string_split(text, '.'),
       lambda f: lower({Q.rx('f', _STRIP, '')})), lambda f: f <> '')) AS signature
FROM conversations""")
def q_fact_signature(spark, d):
    c = Tables(spark, d).conversations
    return c.select("conv_id", "turn", S.fact_signature(F.split("text", r"\.")).alias("signature"))


@query("render_prompt", f"""
SELECT conv_id, turn, printf({Q.lit(X.PROMPT_TEMPLATE)},
       array_to_string(list_transform(string_split(text, chr(10)), lambda f: '- ' || f), chr(10))) AS prompt
FROM conversations""")
def q_render_prompt(spark, d):
    c = Tables(spark, d).conversations
    return c.select("conv_id", "turn", S.render_prompt(F.split("text", "\n")).alias("prompt"))


_REPLY_SRC = """CASE event_type
  WHEN 'view' THEN '{"bio": "' || event_type || ' ' || CAST(user_id AS VARCHAR) || '", "icebreaker": "' || props || '"}'
  WHEN 'click' THEN 'Sure! Here it is: {"bio": "u' || CAST(user_id AS VARCHAR) || '", "icebreaker": "hi"} Thanks.'
  WHEN 'error' THEN '{"bio": "", "icebreaker": "x"}'
  WHEN 'signup' THEN 'no json at all ' || props
  ELSE '  {"icebreaker": "only"}  ' END"""


def _reply_src():
    et, uid, props = F.col("event_type"), F.col("user_id").cast("string"), F.col("props")
    return (F.when(et == "view", F.concat(F.lit('{"bio": "'), et, F.lit(" "), uid,
                                          F.lit('", "icebreaker": "'), props, F.lit('"}')))
            .when(et == "click", F.concat(F.lit('Sure! Here it is: {"bio": "u'), uid,
                                          F.lit('", "icebreaker": "hi"} Thanks.')))
            .when(et == "error", F.lit('{"bio": "", "icebreaker": "x"}'))
            .when(et == "signup", F.concat(F.lit("no json at all "), props))
            .otherwise(F.lit('  {"icebreaker": "only"}  ')))


@query("parse_llm_json", f"""
WITH src AS (SELECT event_id, {_REPLY_SRC} AS raw FROM events),
p AS (SELECT event_id, {Q.rx('raw', _STRIP, '')} AS t FROM src),
q AS (SELECT event_id, t, regexp_extract(t, {Q.lit(S._EMBEDDED_OBJ)}) AS inner_t FROM p),
r AS (SELECT event_id,
        CASE WHEN json_valid(t) THEN json_extract_string(t, '$.bio') END AS wb,
        CASE WHEN json_valid(t) THEN json_extract_string(t, '$.icebreaker') END AS wi,
        CASE WHEN json_valid(inner_t) THEN json_extract_string(inner_t, '$.bio') END AS ib,
        CASE WHEN json_valid(inner_t) THEN json_extract_string(inner_t, '$.icebreaker') END AS ii
      FROM q)
SELECT event_id,
  CASE WHEN coalesce(length(wb), 0) > 0 AND coalesce(length(wi), 0) > 0 THEN wb
       WHEN coalesce(length(ib), 0) > 0 AND coalesce(length(ii), 0) > 0 THEN ib END AS bio,
  CASE WHEN coalesce(length(wb), 0) > 0 AND coalesce(length(wi), 0) > 0 THEN wi
       WHEN coalesce(length(ib), 0) > 0 AND coalesce(length(ii), 0) > 0 THEN ii END AS icebreaker
FROM r""")
def q_parse_llm_json(spark, d):
    e = Tables(spark, d).events
    p = e.select("event_id", S.parse_llm_json(_reply_src()).alias("p"))
    return p.select("event_id", F.col("p.bio").alias("bio"), F.col("p.icebreaker").alias("icebreaker"))


@query("parse_custom_id", """
SELECT event_id,
  CASE WHEN regexp_matches(cid, 'p(\\d+)_t(\\d+)') THEN CAST(regexp_extract(cid, 'p(\\d+)_t(\\d+)', 1) AS BIGINT) END AS persona_id,
  CASE WHEN regexp_matches(cid, 'p(\\d+)_t(\\d+)') THEN CAST(regexp_extract(cid, 'p(\\d+)_t(\\d+)', 2) AS INTEGER) END AS temp_idx
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'bad-' || event_type
      ELSE 'p' || CAST(user_id AS VARCHAR) || '_t' || CAST(CAST(floor(value) AS BIGINT) % 3 AS VARCHAR) END AS cid
      FROM events)""".replace("\\\\", "\\"))
def q_parse_custom_id(spark, d):
    e = Tables(spark, d).events
    cid = F.when(F.col("event_type") == "error", F.concat(F.lit("bad-"), "event_type")).otherwise(
        F.concat(F.lit("p"), F.col("user_id").cast("string"), F.lit("_t"),
                 (F.floor("value").cast("long") % 3).cast("string")))
    return e.select("event_id", *S.parse_custom_id(cid))


@query("rating_to_sentiment", """
SELECT event_id, CASE WHEN value / 10.0 >= 0 AND value / 10.0 <= 2 THEN 'negative'
  WHEN value / 10.0 > 2 AND value / 10.0 <= 3 THEN 'neutral'
  WHEN value / 10.0 > 3 AND value / 10.0 <= 5 THEN 'positive' END AS sentiment FROM events""")
def q_rating(spark, d):
    e = Tables(spark, d).events
    return e.select("event_id", S.rating_to_sentiment(F.col("value") / 10.0).alias("sentiment"))


@query("class_to_label", "SELECT vec_id, CAST(label = 0 AS INTEGER) AS label_bin FROM embeddings")
def q_class_to_label(spark, d):
    e = Tables(spark, d).embeddings
    return e.select("vec_id", S.class_to_label("label", 0).alias("label_bin"))


EVENT_SCORES = {"view": 0.0, "click": 1.0, "signup": 2.5, "purchase": 3.0}


@query("map_score", "SELECT event_id, CASE event_type " + " ".join(
    f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in EVENT_SCORES.items()) + " END AS score FROM events")
def q_map_score(spark, d):
    e = Tables(spark, d).events
    return e.select("event_id", S.map_score("event_type", EVENT_SCORES).alias("score"))


@query("softmax_scores", """
WITH a AS (SELECT vec_id, [CAST(embedding[1] AS DOUBLE) * 10, CAST(embedding[2] AS DOUBLE) * 10,
                           CAST(embedding[3] AS DOUBLE) * 10] AS s FROM embeddings),
b AS (SELECT vec_id, s, list_transform(s, lambda v: exp(v - list_max(s))) AS ex FROM a)
SELECT vec_id, list_transform(ex, lambda v: round(v / list_sum(ex), 6)) AS scores FROM b""")
def q_softmax(spark, d):
    e = Tables(spark, d).embeddings
    s = F.array(*[(F.col("embedding")[i].cast("double") * 10) for i in range(3)])
    return e.select("vec_id", F.transform(S.softmax(s), lambda v: F.round(v, 6)).alias("scores"))


@query("argmax_label", """
WITH a AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b,
                  CAST(embedding[3] AS DOUBLE) AS c FROM embeddings)
SELECT vec_id, CASE WHEN a >= b AND a >= c THEN 'a' WHEN b >= c THEN 'b' ELSE 'c' END AS label,
       greatest(a, b, c) AS confidence FROM a""")
def q_argmax(spark, d):
    e = Tables(spark, d).embeddings
    m = F.create_map(F.lit("a"), F.col("embedding")[0].cast("double"),
                     F.lit("b"), F.col("embedding")[1].cast("double"),
                     F.lit("c"), F.col("embedding")[2].cast("double"))
    best = S.argmax_label(m)
    return e.select("vec_id", best["label"].alias("label"), best["confidence"].alias("confidence"))


@query("confidence_band", """
SELECT event_id, CAST(value / 50.0 >= 0.5 AS INTEGER) AS pred,
  CASE WHEN abs(value / 50.0 - 0.5) < 0.08 THEN 'borderline'
       WHEN abs(value / 50.0 - 0.5) < 0.20 THEN 'moderate' ELSE 'high' END AS band,
  least(greatest(value, 5.0), 40.0) AS clipped, round(value / 7.0, 4) AS rounded
FROM events""")
def q_band(spark, d):
    e = Tables(spark, d).events
    p = F.col("value") / 50.0
    return e.select("event_id", S.apply_threshold(p, 0.5).alias("pred"),
                    S.confidence_band(p, 0.5).alias("band"),
                    S.clip("value", 5.0, 40.0).alias("clipped"),
                    S.round4(F.col("value") / 7.0).alias("rounded"))
