"""Aggregations and corpus statistics.

Every statistic is a grouped aggregate with map-side combining; shares use a
window over the already-aggregated (small) result, never over rows.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clip
from ..plans.prefix import prefix_sum


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """E1."""
    return df.groupBy(label).agg(F.count("*").alias("n"))


def label_share(df: DataFrame, label: str, digits: int = 6) -> DataFrame:
    """Count / total (window over the grouped rows only)."""
    counts = label_distribution(df, label)
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), digits))


def label_by_source(df: DataFrame, a: str, b: str, pivot_values: Sequence | None = None) -> DataFrame:
    """Counts per (a, b); optional pivot of b into columns."""
    if pivot_values is not None:
        return df.groupBy(a).pivot(b, list(pivot_values)).agg(F.count("*"))
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def split_distribution(df: DataFrame, split: str, label: str, digits: int = 4) -> DataFrame:
    """Count and percent per label within each split."""
    counts = df.groupBy(split, label).agg(F.count("*").alias("n"))
    return counts.withColumn(
        "pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(split)), digits))


def rating_distribution(df: DataFrame, c: str) -> DataFrame:
    """E5."""
    return df.groupBy(c).agg(F.count("*").alias("n")).orderBy(c)


def distinct_counts(df: DataFrame, cols: Mapping[str, str], approx: bool = False) -> DataFrame:
    """One row: total rows plus distinct counts (``{alias: column}``)."""
    f = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.countDistinct(c))
    return df.agg(F.count("*").alias("n_rows"), *[f(c).alias(a) for a, c in cols.items()])


def unique_by_group(df: DataFrame, group: str, c: str) -> DataFrame:
    """Distinct values of ``c`` per group (two-phase distinct aggregate)."""
    return df.groupBy(group).agg(F.countDistinct(c).alias("n_unique")).orderBy("n_unique", group)


def token_length_stats(df: DataFrame, tokens: str) -> DataFrame:
    """Rows, mean and exact median of token counts.

    The median works on the histogram of lengths (bounded by the longest
    document), not on rows."""
    n = F.size(tokens)
    return df.agg(F.count("*").alias("n_rows"), F.round(F.avg(n), 6).alias("avg_token_len"),
                  F.median(n).cast("double").alias("median_token_len"))


def top_tokens(df: DataFrame, tokens: str, k: int = 30) -> DataFrame:
    """The k most frequent tokens (tie: token ascending)."""
    return (df.select(F.explode(tokens).alias("token")).groupBy("token")
            .agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(k))


def histogram(df: DataFrame, c: Column | str, lo: float, hi: float, width: float) -> DataFrame:
    """Fixed-width bins over the clipped value."""
    v = clip(c, lo, hi)
    b = F.floor((v - F.lit(lo)) / F.lit(width)).cast("long")
    return df.select(b.alias("bin")).groupBy("bin").agg(F.count("*").alias("n")) \
        .withColumn("bin_lo", F.col("bin") * F.lit(width) + F.lit(lo))


def box_stats(df: DataFrame, c: Column | str, by: str) -> DataFrame:
    """Quartiles (linear interpolation) and whisker bounds per group.

    Rows are counted by value first; the values of a group, however many, are ranked by a distributed prefix sum
    and the one or two that a quartile lies between are picked by rank. ``n`` counts all rows; null values have no
    rank, and a group of nulls alone has null quartiles. A null group is a group."""
    v = F.col(c) if isinstance(c, str) else c
    counts = df.select(F.col(by).alias("__g"), v.cast("double").alias("__v"), v.alias("__x")).groupBy("__g", "__v").agg(
        F.count("*").alias("__c"), F.min("__x").alias("__x"))
    totals = counts.groupBy("__g").agg(F.sum("__c").alias("n"), F.coalesce(F.sum(F.when(F.col("__v").isNotNull(), F.col("__c"))), F.lit(0)).alias("__m"),
                                       F.min("__x").alias("min"), F.max("__x").alias("max"))
    ranked = prefix_sum(counts.where(F.col("__v").isNotNull()).drop("__x"), ["__v"], "__c", "__end", partition=["__g"])
    sizes = totals.select(F.col("__g").alias("__h"), "__m")
    at = ranked.join(sizes, F.col("__g").eqNullSafe(F.col("__h"))).drop("__h")
    holds = lambda i: F.max(F.when((F.col("__end") - F.col("__c") <= i) & (i < F.col("__end")), F.col("__v")))
    picks = []
    for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        rank = F.lit(p) * (F.col("__m") - 1)
        picks += [holds(F.floor(rank)).alias(f"__lo_{name}"), holds(F.ceil(rank)).alias(f"__hi_{name}"),
                  F.max(rank - F.floor(rank)).alias(f"__f_{name}")]
    q = at.groupBy(F.col("__g").alias("__h")).agg(*picks)
    q = q.select("__h", *[(F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__f_{n}")).alias(n)
                          for n in ("q1", "median", "q3")])
    res = totals.join(q, F.col("__g").eqNullSafe(F.col("__h")), "left")
    iqr = F.col("q3") - F.col("q1")
    return res.select(F.col("__g").alias(by), "n", "q1", "median", "q3", "min", "max",
                      F.greatest(F.col("min"), F.col("q1") - 1.5 * iqr).alias("whisker_lo"),
                      F.least(F.col("max"), F.col("q3") + 1.5 * iqr).alias("whisker_hi"))


def flag_rate_by_label(df: DataFrame, label: str, flags: Sequence[str], digits: int = 6) -> DataFrame:
    """Mean of 0/1 flags per label."""
    return df.groupBy(label).agg(*[F.round(F.avg(f), digits).alias(f"{f}_rate") for f in flags])


def emotion_score(label: Column | str, scores: Mapping[str, float]) -> Column:
    """The score of an emotion by a table such as ``fixed.EMOTION_SCORE`` (trimmed, any case); null for others."""
    c = F.col(label) if isinstance(label, str) else label
    table = F.create_map(*[F.lit(x) for kv in scores.items() for x in kv])
    return F.try_element_at(table, F.lower(F.trim(c)))


def emotion_progression(df: DataFrame, turn: str, flow: str, score: Column | str,
                        flows: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """Mean score by turn, one column per flow, sorted by turn. Without ``flows``: one row per (turn, flow),
    whatever flows there are."""
    s = F.col(score) if isinstance(score, str) else score
    scored = df.withColumn("__s", s)
    if flows is None:
        return scored.groupBy(turn, flow).agg(F.round(F.avg("__s"), digits).alias("mean_score"))
    return scored.groupBy(turn).pivot(flow, list(flows)).agg(F.round(F.avg("__s"), digits)).orderBy(turn)


def mean_list_size(df: DataFrame, c: str) -> DataFrame:
    """E15."""
    return df.agg(F.round(F.avg(F.size(c)), 6).alias("mean_size"))


def cost_estimate(df: DataFrame, input_col: Column | str, output_col: Column | str,
                  calls: int, price_in: float, price_out: float, budget: float) -> DataFrame:
    """Mean tokens per call x planned calls x unit prices, budget flag."""
    i = F.col(input_col) if isinstance(input_col, str) else input_col
    o = F.col(output_col) if isinstance(output_col, str) else output_col
    res = df.agg(F.count("*").alias("n_measured"), F.avg(i).alias("avg_in"), F.avg(o).alias("avg_out"))
    est = F.lit(calls) * (F.col("avg_in") * F.lit(price_in) + F.col("avg_out") * F.lit(price_out))
    return res.select("n_measured", F.round("avg_in", 6).alias("avg_in"),
                      F.round("avg_out", 6).alias("avg_out"), F.lit(calls).alias("calls"),
                      F.round(est, 6).alias("estimate"), (est > F.lit(budget)).alias("over_budget"))


def reject_rate(df: DataFrame, rejected: Column) -> DataFrame:
    """Rejected / max(1, total)."""
    return df.agg(F.count("*").alias("total"),
                  F.sum(rejected.cast("long")).alias("rejected")) \
        .withColumn("rejected", F.coalesce("rejected", F.lit(0)).cast("long")) \
        .withColumn("reject_rate", F.round(F.col("rejected") / F.greatest(F.col("total"), F.lit(1)), 6))
