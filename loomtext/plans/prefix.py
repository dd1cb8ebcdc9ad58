"""Distributed prefix sums and positions.

A window ``sum(x) over (partition by g order by o)`` puts a whole group in one
task; a global ``row_number() over (order by o)`` puts the whole table in
one task. Here rows are cut into slices of the ``(g, o)`` key space instead:
a small table of totals (one row per slice and group) yields the offset at which
a group goes on in a slice, and a join on (slice, group) adds it to what runs
inside the slice. A group holding a third of all rows spans many slices.

Two ways to slice, neither of which grows the plan with the number of slices:

* An order that begins with an md5 digest (every seeded order) is cut by the
  digest's leading hex digits: uniform, the same per row on any cluster, no job.
* Any other order is range-partitioned and sorted by Spark, and the rows are
  written once, with their partition and place in it, as a scratch table in the
  shared checkpoint folder. Slice and place are then stored values, the same in
  every branch of the plan and after any recomputation (``spark_partition_id``
  read twice is not: two exchanges sample their own bounds).
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import default_parallelism, written_table

HEX_DIGITS = 3  # 4096 slices per partition of a digest order
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row below


def _digest_slice(c: str) -> Column:
    """Ascending with the digest; a NULL digest sorts first."""
    return F.coalesce(F.conv(F.substring(F.col(c), 1, HEX_DIGITS), 16, 10).cast("int"), F.lit(-1))


def _cells(df: DataFrame, keys: Sequence[str], slices: int | None) -> DataFrame:
    """The rows in order of ``keys``, with __slice and __row (place in the slice, from 0)."""
    spark = df.sparkSession
    n = slices or max(default_parallelism(spark), int(spark.conf.get("spark.sql.shuffle.partitions")))
    cols = [F.col(f"`{k}`") for k in keys]
    placed = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
              .withColumn("__at", F.monotonically_increasing_id()))
    table = written_table(placed, "cells")
    return table.select(*[c for c in table.columns if c != "__at"],
                        F.shiftright("__at", _ROW_BITS).cast("int").alias("__slice"),
                        F.col("__at").bitwiseAND((1 << _ROW_BITS) - 1).alias("__row"))


def _join_totals(rows: DataFrame, totals: DataFrame, part: Sequence[str]) -> DataFrame:
    """The totals of a row's (slice, group) beside the row; a null group is a group like any other."""
    sums = totals.select(F.col("__slice").alias("__slice_o"), *[F.col(c).alias(f"__part_{i}") for i, c in enumerate(part)],
                         *[c for c in totals.columns if c not in ("__slice", *part)])
    on = F.col("__slice") == F.col("__slice_o")
    for i, c in enumerate(part):
        on = on & F.col(c).eqNullSafe(F.col(f"__part_{i}"))
    return rows.join(sums, on, "inner").drop("__slice_o", *[f"__part_{i}" for i in range(len(part))])


def prefix_sums(df: DataFrame, order: Sequence[str], values: Mapping[str, Column | str | int],
                partition: Sequence[str] = (), slices: int | None = None,
                inclusive: bool = True, digest: bool = False) -> DataFrame:
    """Add, for every item of ``values``, a column of that name: the running sum of the value in ascending
    ``order`` within ``partition``, nulls first. ``order`` (column names) must be a total order within a
    partition (append an id to break ties). ``digest`` says that ``order`` begins with a column of lower-case
    hex digests. Rows of a null group are a group like any other."""
    part, order, outs = list(partition), list(order), list(values)
    columns = df.columns
    exprs = [F.lit(v).cast("long") if isinstance(v, int) else F.col(v) if isinstance(v, str) else v
             for v in values.values()]
    base = df.select("*", *[e.alias(f"__v{i}") for i, e in enumerate(exprs)])
    if digest:
        base, inside = base.withColumn("__slice", _digest_slice(order[0])), order
    else:
        base, inside = _cells(base, part + order, slices), ["__row"]
    w = (Window.partitionBy("__slice", *part).orderBy(*inside).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = base.select("*", *[F.sum(f"__v{i}").over(w).alias(f"__s{i}") for i in range(len(outs))])
    totals = base.groupBy("__slice", *part).agg(*[F.sum(f"__v{i}").alias(f"__t{i}") for i in range(len(outs))])
    before = Window.partitionBy(*part).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__slice", *part, *[F.coalesce(F.sum(f"__t{i}").over(before), F.lit(0)).alias(f"__o{i}")
                                                for i in range(len(outs))])
    res = _join_totals(local, offsets, part)
    sums = [F.col(f"__s{i}") + F.col(f"__o{i}") - (F.lit(0) if inclusive else F.col(f"__v{i}")) for i in range(len(outs))]
    return res.select(*[F.col(f"`{c}`") for c in columns if c not in outs], *[s.alias(o) for s, o in zip(sums, outs)])


def prefix_sum(df: DataFrame, order: Sequence[str], value: Column | str | int,
               out: str, partition: Sequence[str] = (), slices: int | None = None,
               inclusive: bool = True, digest: bool = False) -> DataFrame:
    """``prefix_sums`` of one value."""
    return prefix_sums(df, order, {out: value}, partition, slices, inclusive, digest)


def position(df: DataFrame, order: Sequence[str], out: str,
             partition: Sequence[str] = (), slices: int | None = None,
             start: int = 1, digest: bool = False) -> DataFrame:
    """Dense 1-based (or ``start``-based) position in ``order`` within
    ``partition``; equal to ``row_number()`` for a total order."""
    part = list(partition)
    if digest:
        res = prefix_sums(df, order, {out: 1}, part, slices, digest=True)
        return res.withColumn(out, F.col(out) + F.lit(start - 1)) if start != 1 else res
    # places in a slice are stored: no window over the rows
    base = _cells(df, part + list(order), slices)
    totals = base.groupBy("__slice", *part).agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    before = Window.partitionBy(*part).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__slice", *part, "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    at = F.col("__row") - F.col("__first") + F.col("__off") + F.lit(start).cast("long")
    return _join_totals(base, offsets, part).select(*[F.col(f"`{c}`") for c in df.columns if c != out], at.alias(out))
