"""Shared helpers of the training-data operators."""
from __future__ import annotations

import hashlib
import os
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

# Python workers hold one Arrow batch at a time: few rows, so that long texts fit.
ARROW_ROWS = "256"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this subpackage: small Arrow batches, package on the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    ship_package(spark)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_table(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/loomtext-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str | Column = "text") -> Column:
    """The text, empty where null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def vocabulary_file(path: str) -> str:
    """A tokenizer file's place on this machine: the path itself, or the installed
    package's file of that name where a worker keeps it elsewhere."""
    if os.path.exists(path):
        return path
    import public_tokenizers
    return public_tokenizers.path(os.path.basename(path))


def byte_symbols() -> dict[str, int]:
    """The printable symbol of each byte in byte-level vocabularies, to the byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def gathered(batches, chars: int):
    """Lists of the first two columns (ids, texts) of Arrow batches, put together up to about ``chars``."""
    ids, texts, n = [], [], 0
    for batch in batches:
        part = batch.column(1).to_pylist()
        ids += batch.column(0).to_pylist()
        texts += part
        n += sum(map(len, part))
        if n >= chars:
            yield ids, texts
            ids, texts, n = [], [], 0
    if ids:
        yield ids, texts


def stream_sha(separator: str):
    """Over Arrow batches of (key, piece) in order: (key, sha), the SHA-256 of a key's pieces joined by the separator.
    A key may run over any number of batches; what is held is one batch."""
    out = pa.schema([("key", pa.string()), ("sha", pa.string())])

    def run(batches):
        key = sha = None
        for batch in batches:
            done = []
            for k, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k == key and sha is not None:
                    sha.update((separator + piece).encode())
                    continue
                if sha is not None:
                    done.append({"key": key, "sha": sha.hexdigest()})
                key, sha = k, hashlib.sha256(piece.encode())
            yield pa.RecordBatch.from_pylist(done, schema=out)
        if sha is not None:
            yield pa.RecordBatch.from_pylist([{"key": key, "sha": sha.hexdigest()}], schema=out)

    return run
