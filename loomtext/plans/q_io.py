"""Registered queries: sources, sinks, streaming and the Python-helper text steps."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..functions import text as TX
from ..functions import tokens as TK
from ..operators import splits as SP
from ..operators import stats as ST
from ..session import ensure_checkpoint_dir
from ..sources import io as IO
from ..sources.tables import SCHEMAS, Tables
from ..streaming import rowwise as RW
from . import sqlgen as Q
from .q_rows import _split_sql
from .registry import query


@query("scan_csv", "SELECT doc_id, text, lang FROM documents")
def q_scan_csv(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "text", "lang")
    path = IO.sink_table(docs, IO.scratch_dir(spark, "csv"), fmt="csv")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType())])
    return IO.scan_csv(spark, path, schema)


# Latin-1 on disk: characters beyond it are written as '?'.
_TSV_TEXT = Q.rx(Q.rx(Q.rx("text", "[\r\n]+", " "), r"[^\x{00}-\x{FF}]", "?"), f"^[{Q.SP}]+|[{Q.SP}]+$", "")


@query("scan_tsv_labelled", f"""
SELECT CASE WHEN toxic = 1 THEN 'spam' ELSE 'ham' END AS label, {_TSV_TEXT} AS text,
       CAST(coalesce(toxic = 1, false) AS INTEGER) AS label_bin
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE text IS NOT NULL""")
def q_scan_tsv(spark, d):
    t = Tables(spark, d)
    lines = t.documents.join(t.labels, "doc_id").select(F.concat(
        F.when(F.col("toxic") == 1, "spam").otherwise("ham"), F.lit("\t"),
        F.regexp_replace("text", "[\r\n]+", " ")).alias("value"))
    path = IO.scratch_dir(spark, "tsv")
    lines.write.option("sep", "\u0001").option("quote", "\u0000").option("encoding", "ISO-8859-1").csv(path)
    return IO.scan_tsv_labelled(spark, path)


@query("scan_jsonl_nested", """
SELECT conv_id AS persona_id, text AS icebreaker FROM conversations""")
def q_scan_jsonl(spark, d):
    c = Tables(spark, d).conversations
    rec = c.select(S.build_chat_record("conv_id", "role", "text", "gen", F.col("turn") / 10.0).alias("r"))
    path = IO.scratch_dir(spark, "jsonl")
    rec.select("r.*").write.json(path)
    back = IO.scan_jsonl_nested(spark, path)
    return back.select("persona_id", F.col("messages")[1]["content"].alias("icebreaker"))


@query("build_chat_record")
def q_chat_record(spark, d):
    c = Tables(spark, d).conversations
    return c.select(S.build_chat_record("conv_id", "role", "text", "gen", F.col("turn") / 10.0).alias("record"))


@query("scan_splits_union", f"WITH s AS ({_split_sql('labels', 'doc_id', 'toxic', 'doc_id, toxic')}) "
                            "SELECT doc_id, toxic, split FROM s")
def q_splits_union(spark, d):
    lab = Tables(spark, d).labels.select("doc_id", "toxic")
    split = SP.stratified_split(lab, "toxic", "doc_id")
    path = IO.sink_table(split, IO.scratch_dir(spark, "splits"), partition_by=["split"])
    parts = {s: spark.read.parquet(f"{path}/split={s}") for s in ("train", "val", "test")}
    return IO.scan_splits_union(parts).select("doc_id", "toxic", "split")


@query("project_rename", "SELECT event_id AS id, value AS rating, props AS text, ts AS review_date FROM events")
def q_rename(spark, d):
    e = Tables(spark, d).events
    return IO.project_rename(e, {"event_id": "id", "value": "rating", "props": "text", "ts": "review_date"})


@query("require_columns", "SELECT doc_id, text FROM documents")
def q_require(spark, d):
    return IO.require_columns(Tables(spark, d).documents, ["doc_id", "text"]).select("doc_id", "text")


@query("select_existing", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def q_select_existing(spark, d):
    c = Tables(spark, d).customer
    return IO.select_existing(c, ["c_custkey", "c_name", "age", "c_mktsegment", "location"])


@query("sink_table", "SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def q_sink(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "lang")
    path = IO.sink_table(docs, IO.scratch_dir(spark, "sink"), partition_by=["lang"])
    return ST.label_distribution(spark.read.parquet(path), "lang")


@query("sink_stats", f"""
WITH t AS (SELECT {Q.remove_stopwords(Q.tokenize('lower(text)'))} AS tokens FROM documents)
SELECT count(*) AS n_rows, round(avg(len(tokens)), 6) AS avg_token_len,
       CAST(median(len(tokens)) AS DOUBLE) AS median_token_len FROM t""")
def q_sink_stats(spark, d):
    docs = Tables(spark, d).documents.select(TK.remove_stopwords(TK.tokenize(F.lower("text"))).alias("tokens"))
    path = IO.sink_stats(ST.token_length_stats(docs, "tokens"), IO.scratch_dir(spark, "stats"))
    return spark.read.schema("n_rows long, avg_token_len double, median_token_len double").json(path)


@query("stream_clean", f"""
WITH {Q.clean_cte("documents", "doc_id", "text", "classification")}
SELECT doc_id, text_clean FROM cleaned""")
def q_stream_clean(spark, d):
    ensure_checkpoint_dir(spark)
    sdf = RW.table_stream(spark, d, "documents", SCHEMAS["documents"])
    out = RW.apply_rowwise(sdf, lambda s: s.select(
        "doc_id", TX.clean_for_classification("text").alias("text_clean")))
    path = IO.scratch_dir(spark, "stream")
    RW.run_available(out, path, path + "-ckpt")
    return spark.read.schema(out.schema).parquet(path)


# ---------------------------------------------------------------------------
# Table-driven text steps
# ---------------------------------------------------------------------------
@query("fix_unicode", f"WITH t AS MATERIALIZED ({Q.TABLES_SQL}) SELECT page_id, {Q.fix_unicode('html')} AS html_fixed FROM pages, t")
def q_fix_unicode(spark, d):
    p = Tables(spark, d).pages
    return p.select("page_id", TX.fix_unicode("html").alias("html_fixed"))


_EMOJI_SRC = "text || CASE WHEN lang = 'en' THEN ' 😀 ❤' ELSE ' 🎉' END"


@query("emoji_to_text", f"WITH t AS MATERIALIZED ({Q.TABLES_SQL}) SELECT doc_id, {Q.emoji_to_text(_EMOJI_SRC)} AS out FROM documents, t")
def q_emoji(spark, d):
    docs = Tables(spark, d).documents
    src = F.concat("text", F.when(F.col("lang") == "en", F.lit(" 😀 ❤")).otherwise(F.lit(" 🎉")))
    return docs.select("doc_id", TX.emoji_to_text(src).alias("out"))


_CONTRACTED = "I'm sure it's fine, don't worry: "


@query("expand_contractions", f"SELECT doc_id, {Q.contractions(Q.lit(_CONTRACTED) + ' || text')} AS out FROM documents")
def q_contractions(spark, d):
    docs = Tables(spark, d).documents
    src = F.concat(F.lit(_CONTRACTED), "text")
    return docs.select("doc_id", TX.expand_contractions(src).alias("out"))


_FULL = {"emb": "embeddings", "cls": "classification", "sent": "sentiment"}


@query("clean_full", "WITH " + ", ".join(
    Q.clean_cte("(SELECT doc_id, text || ' can''t &eacute;t&#233; ½ 😀' AS text FROM documents)", "doc_id", "text", kind, out, out)
    for out, kind in _FULL.items()) + " SELECT doc_id, emb, cls, sent FROM emb JOIN cls USING (doc_id) JOIN sent USING (doc_id)")
def q_clean_full(spark, d):
    """The three cleaners on texts that every step of theirs changes."""
    docs = Tables(spark, d).documents
    src = F.concat("text", F.lit(" can't &eacute;t&#233; ½ 😀"))
    # the steps that the three begin with are made once
    docs = docs.select("doc_id", src.alias("src")).withColumn("shared", TX.clean_shared("src"))
    return docs.select("doc_id", *[TX.CLEANERS[kind]("src", shared="shared").alias(out) for out, kind in _FULL.items()])
