"""Deterministic splits.

Order inside a stratum is ``md5('<seed>:<id>')``; positions come from the
distributed prefix sum, so one huge label is not one task. Cut points use
integer arithmetic so every engine agrees:
``temp = n - floor(n * 70 / 100)`` rows leave train, then
``test = ceil(temp / 2)`` of them go to test and the rest to validation.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import SEED
from ..plans.prefix import position
from ..session import written_table
from .rows import seeded_key


def _cuts(n_col: str, train_pct: int) -> tuple:
    n = F.col(n_col)
    n_train = F.floor(n * train_pct / 100).cast("long")
    temp = n - n_train
    n_test = F.ceil(temp / 2).cast("long")
    n_val = temp - n_test
    return n_train, n_val


def _assign(pos: str, n_train, n_val):
    p = F.col(pos)
    return (F.when(p <= n_train, "train").when(p <= n_train + n_val, "val")
            .otherwise("test"))


def stratified_split(df: DataFrame, label: str, id_col: str, train_pct: int = 70,
                     seed: int = SEED, out: str = "split") -> DataFrame:
    """Exact per-label 70/15/15 shares in a seeded order; a null label is a label too."""
    keyed = df.withColumn("__k", seeded_key(id_col, seed))
    # one row per label, written: its size decides whether the join is a broadcast
    counts = written_table(df.groupBy(F.col(label).alias("__label")).agg(F.count("*").alias("__n")), "labels")
    ranked = position(keyed, ["__k", id_col], "__pos", partition=[label], digest=True)
    joined = ranked.join(counts, F.col(label).eqNullSafe(F.col("__label")))
    n_train, n_val = _cuts("__n", train_pct)
    return joined.withColumn(out, _assign("__pos", n_train, n_val)).drop("__k", "__n", "__pos", "__label")


def group_split(df: DataFrame, group: str, train_pct: int = 70, seed: int = SEED,
                out: str = "split") -> DataFrame:
    """Whole groups go to one split; cuts on group counts."""
    groups = df.select(group).distinct().withColumn("__k", seeded_key(group, seed))
    ranked = position(groups, ["__k", group], "__pos", digest=True)
    # the group count is one scalar: fetched once, used as a literal
    n = groups.count()
    n_train, n_val = _cuts("__n", train_pct)
    assigned = (ranked.withColumn("__n", F.lit(n).cast("long"))
                .select(group, _assign("__pos", n_train, n_val).alias(out)))
    return df.join(assigned, [group])


def holdout_by_entity(df: DataFrame, entity: str, n_eval: int = 75, seed: int = SEED,
                      out: str = "split") -> DataFrame:
    """D3: the first ``n_eval`` entities in seeded order go to eval."""
    ents = df.select(entity).distinct()
    chosen = (ents.orderBy(seeded_key(entity, seed), entity).limit(n_eval)
              .withColumn("__eval", F.lit(True)))
    return (df.join(F.broadcast(chosen), [entity], "left")
            .withColumn(out, F.when(F.col("__eval"), "eval").otherwise("train")).drop("__eval"))


def route_records(records: DataFrame, entity_ids: DataFrame, key: str,
                  keep: bool = True) -> DataFrame:
    """Records whose entity is (or is not) in the id set."""
    return records.join(entity_ids.select(key).distinct(), [key],
                        "left_semi" if keep else "left_anti")


def query_sample(df: DataFrame, n: int, id_col: str, seed: int = SEED) -> DataFrame:
    """N query rows without replacement (seeded)."""
    from .rows import sample_n
    return sample_n(df, n, id_col, seed)


def split_sizes(df: DataFrame, split_col: str = "split",
                by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(split_col, *by).agg(F.count("*").alias("n"))
