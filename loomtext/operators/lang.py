"""Language detection (B31) as a Spark job: character-trigram naive Bayes.

Profiles are trigram counts per language from labelled text (``groupBy``).
A document's score for a language is
``n * ln(1 / (T_l + V)) + sum_tri ln(c_l(tri) + 1)`` over all trigrams of the
whole text: add-one smoothing where only trigrams present in the profile need
a join; the first term covers the rest. Argmax per document, ties by language
name. Texts of ``min_chars`` characters or fewer are ``und``.
"""
from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A profile row: up to 12 bytes of trigram, one weight per language, row overhead.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 96
SALTS = 32


def trigrams(text: str) -> Column:
    """Every overlapping trigram of the whole lower-cased text, in one regex pass."""
    s = F.lower(F.coalesce(F.col(text), F.lit("")))
    return F.regexp_extract_all(s, F.lit("(?s)(?=(.{3}))"), 1)


def fit_profiles(labelled: DataFrame, text: str, label: str) -> DataFrame:
    """``(lang, tri, c)`` counts of trigrams per language; rows without a label don't count."""
    t = labelled.filter(F.col(label).isNotNull()).select(F.col(label).alias("lang"),
                                                         F.explode(trigrams(text)).alias("tri"))
    # the fitted profile is read several times by ``detect_language``: keep it
    return t.groupBy("lang", "tri").agg(F.count("*").alias("c")).persist(StorageLevel.MEMORY_AND_DISK)


def detect_language(df: DataFrame, id_col: str, text: str, profiles: DataFrame,
                    min_chars: int = 30) -> DataFrame:
    """``(id, lang_pred)``, one row per id; the languages are the profile's.

    The profile, one row per trigram with a weight per language, is broadcast
    where its counted rows fit ``BROADCAST_BYTES``; a larger one is copied
    ``SALTS`` times and joined on (trigram, salt of the document), so that a
    frequent trigram is spread. Scores are summed map-side, then by id.
    """
    totals = {r.lang: r.T for r in profiles.groupBy("lang").agg(F.sum("c").alias("T")).collect()}
    langs = sorted(totals)
    wide = profiles.groupBy("tri").agg(
        *[F.coalesce(F.sum(F.when(F.col("lang") == x, F.log(F.col("c") + 1))), F.lit(0.0)).alias(f"w{i}")
          for i, x in enumerate(langs)]).persist(StorageLevel.MEMORY_AND_DISK)
    n_vocab = wide.count()
    tris = df.select(F.col(id_col).alias("id"), F.length(text).alias("len"),
                     F.explode_outer(trigrams(text)).alias("tri"))
    if n_vocab * (ROW_BYTES + 8 * len(langs)) <= BROADCAST_BYTES:
        hits = tris.join(F.broadcast(wide), "tri", "left")
    else:
        salted = wide.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        hits = (tris.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
                .join(salted, ["tri", "salt"], "left"))
    sums = hits.groupBy("id", "len").agg(
        F.count("tri").alias("n"),
        *[F.coalesce(F.sum(f"w{i}"), F.lit(0.0)).alias(f"h{i}") for i in range(len(langs))])
    scored = [F.struct((-F.round(F.col("n") * F.log(F.lit(1.0) / F.lit(totals[x] + n_vocab)) + F.col(f"h{i}"), 9))
                       .alias("s"), F.lit(x).alias("lang")) for i, x in enumerate(langs)]
    best = F.array_min(F.array(*scored))["lang"] if langs else F.lit(None).cast("string")
    known = (F.col("len") > min_chars) & (F.col("n") > 0) & best.isNotNull()
    return sums.select(F.col("id").alias(id_col), F.when(known, best).otherwise(F.lit("und")).alias("lang_pred"))
