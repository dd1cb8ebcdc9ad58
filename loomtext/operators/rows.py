"""Filters, dedup, union, sampling, ids, persona blocks."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed as X
from ..functions.fixed import SEED
from ..functions.scalars import fact_signature, strip_ws, word_count
from ..functions.text import is_blank
from ..plans.prefix import position, prefix_sum


def seeded_key(c: Column | str, seed: int = SEED) -> Column:
    """Shared pseudo-random order: md5('<seed>:<value>'). Same in SQL engines."""
    v = F.col(c) if isinstance(c, str) else c
    return F.md5(F.concat(F.lit(f"{seed}:"), v.cast("string")))


def drop_null_text(df: DataFrame, cols: Sequence[str] = ("text",)) -> DataFrame:
    """C1."""
    return df.dropna(subset=list(cols))


def drop_blank(df: DataFrame, c: str = "text") -> DataFrame:
    """Empty or whitespace-only strings (and NULL) removed."""
    return df.filter(~is_blank(c))


def min_length_filter(df: DataFrame, c: str = "text", min_chars: int | None = 50,
                      min_words: int | None = None) -> DataFrame:
    """``len > min_chars`` on raw text; ``words >= min_words`` on clean text."""
    cond = F.lit(True)
    if min_chars is not None:
        cond = cond & (F.length(F.col(c)) > min_chars)
    if min_words is not None:
        cond = cond & (word_count(c) >= min_words)
    return df.filter(cond)


def language_filter(df: DataFrame, c: str = "lang", keep: Sequence[str] = ("en",)) -> DataFrame:
    """C4."""
    return df.filter(F.col(c).isin(list(keep)))


def dedup_keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str],
                     drop_empty_key: bool = False) -> DataFrame:
    """First row per key by ``order``.

    Written as ``min(struct(order..., row))`` per key rather than a
    ``row_number`` window: the aggregate combines map-side, so a key holding
    a third of the table is reduced in every task before the shuffle.

    ``drop_empty_key`` removes the group whose (single) key is '' as a HAVING
    condition: a filter on a derived key column would otherwise be pushed
    into the projection and evaluate the key expression twice.
    """
    key = list(key)
    order = list(order)
    payload = [c for c in df.columns if c not in key]
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                      F.struct(*payload).alias("__row"))
    aggs = [F.min(packed).alias("__m")]
    if drop_empty_key:
        aggs.append(F.max((F.col(key[0]) == "").cast("int")).alias("__empty"))
    agg = df.groupBy(*key).agg(*aggs)
    if drop_empty_key:
        agg = agg.filter(F.col("__empty") == 0)
    return agg.select(*key, "__m.__row.*").select(*df.columns)


def first_ids(df: DataFrame, key: str, id_col: str, drop_empty_key: bool = False) -> DataFrame:
    """C5 where only the ids are wanted: the smallest ``id_col`` (a number) per
    key. The key is shuffled as a 32-byte digest and both buffers are
    primitive, so it is a hash aggregate that never sorts or carries texts.
    NULL keys are one group. ``drop_empty_key`` as in ``dedup_keep_first``."""
    narrow = df.select(F.unhex(F.sha2(F.col(key), 256)).alias("__key"), F.col(id_col),
                       F.coalesce(F.col(key) == "", F.lit(False)).cast("int").alias("__empty"))
    firsts = narrow.groupBy("__key").agg(F.min(id_col).alias(id_col), F.max("__empty").alias("__empty"))
    if drop_empty_key:
        firsts = firsts.filter(F.col("__empty") == 0)
    return firsts.select(id_col)


def union_sources(frames: Sequence[tuple[str, DataFrame]], tag: str = "source",
                  rank: str | None = "source_rank") -> DataFrame:
    """Stack sources by name, tag each with its name and order."""
    out = None
    for i, (name, d) in enumerate(frames):
        d = d.withColumn(tag, F.lit(name))
        if rank:
            d = d.withColumn(rank, F.lit(i))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def sample_n(df: DataFrame, n: int, id_col: str, seed: int = SEED) -> DataFrame:
    """Exactly ``min(n, count)`` rows, repeatable (top-n of a hash order;
    each task keeps only n rows before the merge)."""
    return df.orderBy(seeded_key(id_col, seed), F.col(id_col)).limit(n)


def shuffle_rows(df: DataFrame, id_col: str, seed: int = SEED) -> DataFrame:
    """Seeded permutation (global range sort on the hash key)."""
    return df.withColumn("__k", seeded_key(id_col, seed)).orderBy("__k", id_col).drop("__k")


def assign_row_id(df: DataFrame, order: Sequence[str], out: str = "row_id", digest: bool = False) -> DataFrame:
    """Sequential ids 0..N-1 in ``order`` without a single-task window; ``digest``: the order begins
    with a hex digest (a seeded order)."""
    return position(df, list(order), out, start=0, digest=digest)


def persona_fact(line: Column | str) -> Column:
    """The fact of a stripped ``N your persona: fact`` line, '' for any other line."""
    return strip_ws(F.regexp_extract(line, X.PERSONA_FACT_RE, 1))


def persona_blocks(df: DataFrame, file_col: str | None, line_cols: Sequence[str], text_col: str) -> DataFrame:
    """A line ``1 your persona:`` opens a block; lines ``N your persona:
    fact`` give its facts, without the number; other lines and blank facts
    are left out. Facts before the first start are a block of their own (0).
    Of blocks with the same facts (order and case aside) the first stays.

    Output is long: one row per fact, ``(file?, block_no, line..., fact)``;
    a block's facts are its rows in line order. Block numbers are running
    sums of the start flag within a file (or the whole input when
    ``file_col`` is None), computed with the distributed prefix sum, so
    neither a huge file nor a huge block is ever gathered into one task or
    one array.
    """
    line_cols = list(line_cols)
    part = [file_col] if file_col else []
    line = strip_ws(F.coalesce(text_col, F.lit("")))
    marked = df.select(*part, *line_cols, line.rlike(X.PERSONA_START_RE).cast("long").alias("__start"),
                       persona_fact(line).alias("fact"))
    marked = marked.filter((F.col("__start") == 1) | (F.col("fact") != ""))
    numbered = prefix_sum(marked, line_cols, "__start", "block_no", partition=part)
    block = F.struct(*part, "block_no") if part else F.col("block_no")
    kept = persona_structured_long(numbered.withColumn("__block", block), "__block", line_cols, "fact")
    ids = [F.col(f"id.{c}") for c in (*part, "block_no")] if part else [F.col("id").alias("block_no")]
    return kept.select(*ids, *line_cols, "fact")


def persona_structured(df: DataFrame, facts_col: str = "facts", id_col: str = "id") -> DataFrame:
    """C11 for records that carry their facts as an array field: trim facts,
    drop empty ones and empty personas, first per signature."""
    cleaned = (df.withColumn(facts_col, F.filter(F.transform(facts_col, strip_ws), lambda f: f != ""))
               .filter(F.size(facts_col) > 0)
               .withColumn("signature", fact_signature(facts_col)))
    return dedup_keep_first(cleaned, ["signature"], [id_col])


def _md5_chunk(c: Column, i: int) -> Column:
    # 32 bits of the md5 hex digest as a non-negative long
    return F.conv(F.substring(F.md5(c), 8 * i + 1, 8), 16, 10).cast("long")


def persona_signature_long(facts: DataFrame, id_col: str, fact_col: str = "fact") -> DataFrame:
    """``(id, signature)`` for personas stored one fact per row.

    The signature identifies the multiset of lower-cased facts without
    gathering it: fact count plus four sums of 32-bit md5 slices (an
    order-independent 128-bit multiset hash), all map-side combined sums.
    """
    lf = F.lower(F.col(fact_col))
    parts = [F.count("*").alias("__n")] + [F.sum(_md5_chunk(lf, i)).alias(f"__h{i}") for i in range(4)]
    sig = F.concat_ws(":", *[F.col(c).cast("string") for c in ["__n", "__h0", "__h1", "__h2", "__h3"]])
    return facts.groupBy(id_col).agg(*parts).select(id_col, sig.alias("signature"))


def persona_structured_long(df: DataFrame, id_col: str, order_cols: Sequence[str],
                            fact_col: str) -> DataFrame:
    """C11 for personas stored one fact per row: trim facts, drop empty ones
    (a persona without facts disappears with them), keep the first persona
    (lowest id) per signature. Returns ``(id, order..., fact, signature)``.

    Everything is sums, a min per signature and an equi-join on id; a
    signature shared by a third of all personas is combined map-side.
    """
    facts = (df.select(F.col(id_col).alias("id"), *order_cols, strip_ws(fact_col).alias("fact"))
             .filter(F.col("fact") != ""))
    sigs = persona_signature_long(facts, "id")
    keep = sigs.groupBy("signature").agg(F.min("id").alias("id"))
    return facts.join(keep, "id").select("id", *order_cols, "fact", "signature")


def record_layout(df: DataFrame, candidates: Sequence[str] = X.PERSONA_FIELDS) -> Column:
    """C12 of every row, a struct ``(kind, field)``: ('structured', field) for a non-empty list of
    strings, candidates before other fields; ('text', 'text') when the text
    is a persona line; else ('unknown', null)."""
    lists = [f.name for f in df.schema.fields if f.dataType in (T.ArrayType(T.StringType(), True), T.ArrayType(T.StringType(), False))]
    lists.sort(key=lambda c: list(candidates).index(c) if c in candidates else len(candidates))
    texts = [f.name for f in df.schema.fields if f.name == "text" and f.dataType == T.StringType()]
    kind = lambda k, c: F.struct(F.lit(k).alias("kind"), F.lit(c).cast("string").alias("field"))
    hits = [F.when(F.get(c, F.lit(0)).isNotNull(), kind("structured", c)) for c in lists]
    hits += [F.when(F.col(c).rlike(X.PERSONA_FACT_RE), kind("text", c)) for c in texts]
    return F.coalesce(*hits, kind("unknown", None))


def detect_layout(df: DataFrame, candidates: Sequence[str] = X.PERSONA_FIELDS) -> tuple[str, str | None]:
    """C12 of a table, by its first row; an empty table is unknown."""
    first = df.select(record_layout(df, candidates).alias("l")).first()
    return (first["l"]["kind"], first["l"]["field"]) if first else ("unknown", None)


def diverse_sample(df: DataFrame, cluster_col: str, id_col: str, target_n: int,
                   seed: int = SEED) -> DataFrame:
    """Round-robin over clusters in a seeded order, one member per cluster
    per round, members in a seeded order, first ``target_n`` picks."""
    keyed = df.withColumn("__mk", seeded_key(id_col, seed))
    ranked = position(keyed, ["__mk", id_col], "round", partition=[cluster_col], digest=True)
    return (ranked.withColumn("__ck", seeded_key(cluster_col, seed))
            .orderBy("round", "__ck", cluster_col).limit(target_n)
            .drop("__mk", "__ck"))


def overlap_between_splits(df: DataFrame, split_col: str = "split", text_col: str = "text",
                           splits: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """C14: unique texts per split and pairwise overlaps (percent of the
    first split's unique texts, divided by max(n, 1))."""
    # one row per distinct text with a 0/1 flag per split (map-side combined)
    per_text = df.groupBy(text_col).agg(*[
        F.max((F.col(split_col) == s).cast("int")).alias(f"in{i}") for i, s in enumerate(splits)])
    pairs = [(i, j) for i in range(len(splits)) for j in range(i + 1, len(splits))]
    sums = per_text.agg(
        *[F.sum(f"in{i}").cast("long").alias(f"n{i}") for i in range(len(splits))],
        *[F.sum(F.col(f"in{i}") * F.col(f"in{j}")).cast("long").alias(f"o{i}_{j}") for i, j in pairs])
    rows = F.array(*[F.struct(F.lit(splits[i]).alias("split_a"), F.lit(splits[j]).alias("split_b"),
                              F.coalesce(F.col(f"o{i}_{j}"), F.lit(0)).alias("overlap"),
                              F.coalesce(F.col(f"n{i}"), F.lit(0)).alias("n_unique_a"))
                     for i, j in pairs])
    out = sums.select(F.inline(rows))
    return out.withColumn("pct", F.round(F.col("overlap") * 100.0 /
                                         F.greatest(F.col("n_unique_a"), F.lit(1)), 4))


def assert_disjoint(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: shared key count and whether it is zero."""
    shared = a.select(*key).distinct().join(b.select(*key).distinct(), list(key), "left_semi")
    return shared.agg(F.count("*").alias("n_shared")).withColumn("ok", F.col("n_shared") == 0)


def assert_unique_sequential(df: DataFrame, id_col: str, sig_col: str | None = None) -> DataFrame:
    """Ids are 0..N-1 and unique; signatures unique."""
    aggs = [F.count("*").alias("n"), F.countDistinct(id_col).alias("n_ids"),
            F.min(id_col).alias("min_id"), F.max(id_col).alias("max_id")]
    if sig_col:
        aggs.append(F.countDistinct(sig_col).alias("n_sigs"))
    res = df.agg(*aggs)
    ok = (F.col("n") == F.col("n_ids")) & (F.col("min_id") == 0) & (F.col("max_id") == F.col("n") - 1)
    if sig_col:
        ok = ok & (F.col("n_sigs") == F.col("n"))
    return res.withColumn("ok", ok)
