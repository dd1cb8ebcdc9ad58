"""Sources and sinks.

Reads take a declared schema (no inference) and ``FAILFAST``; writes are
partitioned Parquet (JSON/CSV optional). Output folders must be shared
storage on a cluster: ``scratch_dir`` derives them from the session's
checkpoint folder.
"""
from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's (shared) checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/io-{name}-{uuid.uuid4().hex[:12]}"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A1: header, quoted multi-line fields, '' and NA read as missing."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("nullValue", "")
            .option("mode", "FAILFAST").csv(path)
            .select(*[F.when(F.col(f.name).cast("string") == "NA", None).otherwise(F.col(f.name))
                      .cast(f.dataType).alias(f.name) for f in schema.fields]))


def scan_tsv_labelled(spark: SparkSession, path: str, encoding: str = "ISO-8859-1",
                      positive: str = "spam") -> DataFrame:
    """A2: lines ``label<TAB>text`` (split at the first tab), blank lines
    skipped, both parts stripped, ``label_bin = lower(label) == positive``."""
    from ..functions.scalars import strip_ws
    # one column per line: a separator and quote that never occur, so the
    # reader only splits lines (splittable, decoded with the given charset)
    raw = (spark.read.schema("value string").option("sep", "\u0001").option("quote", "\u0000")
           .option("encoding", encoding).option("header", False).csv(path))
    lines = raw.filter(F.col("value").rlike(r"\S"))
    label = strip_ws(F.substring_index("value", "\t", 1))
    text = F.when(F.instr("value", "\t") > 0,
                  strip_ws(F.expr("substring(value, instr(value, '\t') + 1)"))).otherwise(F.lit(""))
    return lines.select(label.alias("label"), text.alias("text"),
                        (F.lower(label) == positive).cast("int").alias("label_bin"))


CHAT_SCHEMA = T.StructType([
    T.StructField("persona_id", T.LongType()),
    T.StructField("gen_model", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("messages", T.ArrayType(T.StructType([
        T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))),
])


def scan_jsonl_nested(spark: SparkSession, path: str, schema: T.StructType = CHAT_SCHEMA) -> DataFrame:
    """A3: one JSON record per line with a declared nested schema."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def scan_splits_union(frames: Mapping[str, DataFrame], tag: str = "split") -> DataFrame:
    """A4: stack named splits, tagging each row with its split."""
    out = None
    for name, df in frames.items():
        d = df.withColumn(tag, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def project_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """A5: keep the mapped columns under their new names."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fail on the driver, before any job, when columns are missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def select_existing(df: DataFrame, want: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in want if c in df.columns])


def sink_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
               mode: str = "overwrite") -> str:
    """Write a table (partitioned by e.g. ``split``)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')
    w.format(fmt).save(path)
    return path


def sink_stats(stats: DataFrame, path: str) -> str:
    """One-row (nested) statistics table written as JSON."""
    stats.coalesce(1).write.mode("overwrite").json(path)
    return path
