"""Cross-site boilerplate lines by distinct-site spread.

1. Lines (trimmed, blank ones aside) are hashed to 128 bits. Per line one
   aggregation merges a HyperLogLog sketch of its sites with the number of its
   occurrences and its smallest doc_id; partial sketches are merged in every
   task before the shuffle, so a line that a third of all documents have is no
   single task's work.
2. The sketch has four registers and more per wanted site, and at small counts
   its estimate is a function of how many registers are filled. Filled
   registers never exceed the true number of sites: a line whose estimate says
   ``min_sites`` registers is surely spread. Lines below that, but with
   ``min_sites`` occurrences and more, are near the threshold (two sites may
   have met in a register): their sites are counted exactly. Lines with fewer
   occurrences cannot be spread. The outcome equals exact counting.
3. Spread lines are taken out of every document but the first that has them
   (smallest doc_id). A document without any other line, whose whole text is also
   that of another document, is a full copy: it is left whole, for near-duplicate
   removal.

DataFrame operations only.

Defined cases: null text counts as empty; null sites are no site; a null doc_id
is never the first to have a line; repeated rows are treated alike; line breaks
are "\\n"; texts without spread lines stay as they are, null ones null; other
columns of the documents pass through, whatever their names.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, scratch_table, text_key, whole_text

MIN_SITES = 5


def _sketch_plan(min_sites: int) -> tuple[float, int]:
    """(relative error for Spark's sketch, estimate from which min_sites registers are surely filled)."""
    registers = 1 << max(5, math.ceil(math.log2(4 * min_sites)))
    sure = round(registers * math.log(registers / (registers - min_sites)))
    return 1.106 / math.sqrt(registers) + 1e-6, sure


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """d, k (document), pos, site, h1, h2 of every line that isn't blank."""
    line = F.trim("line")
    return (docs.select(F.col("doc_id").cast("long").alias("d"), whole_text().alias("t"),
                        F.col(site).cast("string").alias("site"))
            .select("d", text_key(F.col("t")).alias("k"), "site", F.posexplode_outer(F.split("t", "\n", -1)).alias("pos", "line"))
            .where(line != "")
            .select("d", "k", "pos", "site", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(17), line).alias("h2")))


def spread_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """Occurrences of spread lines: d, k, pos, remove (not in the line's first document)."""
    rsd, sure = _sketch_plan(min_sites)
    lines = _lines(docs, site)
    often = (lines.groupBy("h1", "h2")
             .agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("site", rsd).alias("estimate"),
                  F.min("d").alias("first"))
             .where(F.col("n") >= min_sites).select("h1", "h2", "estimate", "first"))
    often = scratch_table(often, "often")
    held = scratch_table(lines.join(often, ["h1", "h2"]), "held")
    near = (held.where(F.col("estimate") < sure).where("site IS NOT NULL").select("h1", "h2", "site").distinct()
            .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites))
    near = scratch_table(near.select("h1", "h2"), "near")
    spread = held.where(F.col("estimate") >= sure).unionByName(
        held.where(F.col("estimate") < sure).join(near, ["h1", "h2"], "left_semi").select(held.columns))
    return spread.select("d", "k", "pos",
                         F.coalesce(F.col("d") != F.col("first"), F.lit(True)).alias("remove"))


def remove_spread(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """All columns of the documents, with ``text`` cleaned, and __n_lines, __n_removed."""
    prepare(docs.sparkSession)
    # identical rows (same id, same text) are cleaned alike: their positions are gathered as a set
    marked = (spread_lines(docs, site, min_sites)
              .groupBy("d", "k").agg(F.collect_set(F.struct("pos", "remove")).alias("__spread"), F.count(F.lit(1)).alias("__n"))
              .select(F.col("d").alias("__d"), F.col("k").alias("__k"), "__spread", "__n"))
    marked = scratch_table(marked, "marked")
    nameless = F.when(F.col("__d").isNull(), F.col("__n") / F.size("__spread")).otherwise(0)
    copied = (marked.groupBy("__k").agg(F.min("__d").alias("low"), F.max("__d").alias("high"), F.sum(nameless).alias("nameless"))
              .where((F.col("nameless") + F.when(F.col("high").isNull(), 0).when(F.col("low") < F.col("high"), 2).otherwise(1)) >= 2)
              .select("__k", F.lit(True).alias("__copied")))
    marked = marked.drop("__n").join(scratch_table(copied, "copied"), "__k", "left")

    own = docs.select("*", F.col("doc_id").cast("long").alias("__d0"), text_key(whole_text()).alias("__k0"))
    joined = own.join(marked, F.col("__d0").eqNullSafe(F.col("__d")) & (F.col("__k0") == F.col("__k")), "left")
    # positions by set difference, so that a text of many spread lines costs no more than its lines
    spread = F.coalesce("__spread", F.array().cast("array<struct<pos:int,remove:boolean>>"))
    parts = joined.select("*", F.split(F.col("text").cast("string"), "\n", -1).alias("__lines"),
                          F.transform(spread, lambda m: m["pos"]).alias("__seen"),
                          F.transform(F.filter(spread, lambda m: m["remove"]), lambda m: m["pos"]).alias("__gone"))
    every = F.sequence(F.lit(0), F.size("__lines") - 1)
    line = lambda i: F.element_at("__lines", i + 1)
    has_own = F.exists(F.array_except(every, "__seen"), lambda i: F.trim(line(i)) != "")
    parts = parts.withColumn("__cut", (F.size("__gone") > 0) & ~(F.coalesce("__copied", F.lit(False)) & ~has_own))
    kept = F.array_join(F.transform(F.array_except(every, "__gone"), line), "\n")
    text = F.when(F.col("__cut"), kept).otherwise(F.col("text").cast("string"))
    return parts.select(
        *[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.when(F.col("text").isNull(), 0).otherwise(F.size("__lines")).cast("long").alias("__n_lines"),
        F.when(F.col("__cut"), F.size("__gone")).otherwise(0).cast("long").alias("__n_removed"))


def report(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, n_lines, n_removed, text: every document after the removal."""
    done = remove_spread(docs.select("doc_id", "text", F.col(site).alias("source")), "source", min_sites)
    return done.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), "text")
