"""Recommendation formatting, baselines and metadata metrics."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import SEED
from ..functions.scalars import city_of, norm_category, preview
from ..plans.prefix import position
from .rows import seeded_key


def format_recommendations(recs: DataFrame, profiles: DataFrame, id_col: str,
                           keep: Sequence[str], text_col: str, preview_len: int = 220) -> DataFrame:
    """Rank, score rounded to 4, profile columns that exist, preview; the
    raw text itself is dropped."""
    cols = [c for c in keep if c in profiles.columns]
    prof = profiles.select(F.col(id_col).alias("cid"), *cols,
                           preview(text_col, preview_len).alias("bio_preview"))
    return (recs.join(prof, "cid")
            .select(F.col("qid").alias("query_id"), "rank",
                    F.round("score", 4).alias("similarity_score"),
                    F.col("cid").alias("profile_id"), *cols, "bio_preview"))


def compare_methods(results: Mapping[str, DataFrame]) -> DataFrame:
    """Stack per-method results with a ``method`` tag."""
    out = None
    for name, df in results.items():
        d = df.select(F.lit(name).alias("method"), "qid", "cid", "rank")
        out = d if out is None else out.unionByName(d)
    return out


def random_baseline(queries: DataFrame, cands: DataFrame, id_col: str, k: int,
                    seed: int = SEED) -> DataFrame:
    """K random others per query without pairing every query with every
    candidate: candidates get positions in a seeded permutation, and a query
    draws k distinct distances from its own position (cyclic), from a hashed
    start and by a hashed step of its own. Queries must be members of the
    candidate table. Emits Q * k rows through an equi-join."""
    perm = position(cands.select(id_col).withColumn("__k", seeded_key(id_col, seed)),
                    ["__k", id_col], "__pos", start=0, digest=True).drop("__k")
    n = cands.count()
    qpos = queries.select(F.col(id_col).alias("qid")).join(
        perm.select(F.col(id_col).alias("qid"), F.col("__pos").alias("__qpos")), "qid")
    k, others = min(k, n - 1), n - 1
    if k < 1:
        return perm.select(F.col(id_col).alias("qid"), F.col(id_col).alias("cid"), F.lit(1).alias("rank")).limit(0)
    digest = F.md5(F.concat(F.lit("draw:"), F.col("qid").cast("string")))
    start = F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") % others
    step = F.conv(F.substring(digest, 8, 7), 16, 10).cast("long") % (others // k) + 1
    away = (start + (F.col("rank") - 1) * step) % others + 1
    want = (qpos.select("qid", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"), "__qpos")
            .withColumn("__pos", (F.col("__qpos") + away) % n))
    return (want.join(perm.select(F.col(id_col).alias("cid"), "__pos"), "__pos")
            .select("qid", "cid", "rank"))


def metadata_metrics(recs: DataFrame, profiles: DataFrame, id_col: str,
                     same_cols: Mapping[str, str], city_col: str | None = None,
                     age_col: str | None = None, top_k: int | None = None) -> DataFrame:
    """One row per (method, query).

    ``same_<name>_at_k``: share of non-blank candidate values equal to the
    query's (normalised); NULL when the query value is blank or no candidate
    value is non-blank. ``same_city_at_k`` does the same on the text before
    the first comma. ``avg_age_diff``: mean absolute difference over numeric
    candidate values; NULL when the query value is not numeric."""
    attrs = [norm_category(c).alias(n) for n, c in same_cols.items()]
    if city_col:
        attrs.append(city_of(city_col).alias("city"))
    if age_col:
        attrs.append(F.col(age_col).cast("string").try_cast("double").alias("age"))
    prof = profiles.select(F.col(id_col).alias("__id"), *attrs)
    names = list(same_cols) + (["city"] if city_col else [])
    q = prof.select(F.col("__id").alias("qid"), *[F.col(n).alias("q_" + n) for n in names],
                    *([F.col("age").alias("q_age")] if age_col else []))
    c = prof.select(F.col("__id").alias("cid"), *[F.col(n).alias("c_" + n) for n in names],
                    *([F.col("age").alias("c_age")] if age_col else []))
    j = recs.join(q, "qid").join(c, "cid")
    aggs = []
    for n in names:
        eq = F.when((F.col("q_" + n) != "") & (F.col("c_" + n) != ""),
                    (F.col("q_" + n) == F.col("c_" + n)).cast("double"))
        aggs.append(F.avg(eq).alias(f"same_{n}_at_k"))
    if age_col:
        aggs.append(F.avg(F.abs(F.col("c_age") - F.col("q_age"))).alias("avg_age_diff"))
    aggs.append(F.count("*").alias("top_k") if top_k is None else F.lit(top_k).alias("top_k"))
    return j.groupBy("method", "qid").agg(*aggs)


def summarize_eval(details: DataFrame, digits: int = 6) -> DataFrame:
    """Mean of every metric per method (NULL skipped), query count, k."""
    metrics = [c for c in details.columns if c.startswith("same_") or c == "avg_age_diff"]
    return details.groupBy("method").agg(
        F.countDistinct("qid").alias("n_queries"), F.max("top_k").alias("top_k"),
        *[F.round(F.avg(m), digits).alias(m) for m in metrics])
