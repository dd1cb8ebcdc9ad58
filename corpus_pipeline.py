"""The corpus pipeline: quality, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet to the shared checkpoint folder and reads them
again as the next one's docs. All stages but the last return the columns of
``documents`` (other columns of the input are dropped by the first).
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm import fss_neardup, line_spread, packing, pu_quality, wu_manber
from loomtext.llm.common import read_table, scratch_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, n_chars following the text as it now is."""
    return docs.select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    net = pu_quality.fit(docs, read_table(spark, sf_dir, "labels"))
    rows = docs.withColumn("__id", F.col("doc_id"))
    scored = pu_quality.score_texts(rows, net, ("text", "lang", "source", "n_chars", "__id"))
    return scored.where(F.col("score") >= pu_quality.THRESHOLD).select(F.col("__id").alias("doc_id"), *COLUMNS[1:])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines spread over sites go from all documents but their first."""
    return _documents(line_spread.remove_spread(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the smallest doc_id stays, once.

    Rows are linked, not ids: of equal (doc_id, text) one row stays, different texts under one id are rows of
    their own, and rows without an id come last, so one of them stays only where no row with an id is like it."""
    rows = fss_neardup.numbered_rows(docs, COLUMNS)
    found = fss_neardup.link(rows.select(F.col("__row").alias("doc_id"), "text")).where("NOT kept")
    return rows.join(found.select(F.col("doc_id").alias("__row")), "__row", "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    leaks = wu_manber.find_leaks(docs, read_table(spark, sf_dir, "benchmark"), extra=COLUMNS[1:])
    return leaks.where("NOT contaminated").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("pack", pack)]

#: The classifier and the sketches can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
