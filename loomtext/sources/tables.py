"""Driver tables: declared schemas and column-pruned parquet reads."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import default_parallelism

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

SCHEMAS: dict[str, T.StructType] = {
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType())]),
    "labels": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType())]),
    "conversations": T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]),
    "embeddings": T.StructType([
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType())]),
    "benchmark": T.StructType([
        T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]),
    "pages": T.StructType([
        T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType())]),
    "events": T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())]),
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType())]),
    "nation": T.StructType([
        T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType())]),
}


# Tables whose rows carry long text: CPU-heavy row-wise work follows.
TEXT_TABLES = frozenset({"documents", "pages", "conversations", "benchmark"})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; Catalyst prunes columns and pushes filters.

    A text table that arrives in fewer input splits than the session has
    cores (e.g. one large row group) is spread round-robin first, so the
    regex-heavy projections run on every core. With real inputs (thousands
    of splits) this is a no-op and no shuffle is added."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    if name in TEXT_TABLES:
        want = default_parallelism(spark)
        if df.rdd.getNumPartitions() < want:
            df = df.repartition(want)
    return df


class Tables:
    """Lazy accessor: ``Tables(spark, d).documents``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)
