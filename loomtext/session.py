"""SparkSession construction and lineage helpers.

Settings favour large clusters: AQE re-plans joins and partition counts at
runtime, skew-join splitting is on, Arrow carries the few Python batches.
Nothing here overrides a value the cluster already set.
"""
from __future__ import annotations

import os
import sys
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608b",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "loomtext", master: str | None = None,
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Return the active session or build one with the defaults above.

    ``master`` is only applied when no session exists (tests, bench); on a
    cluster the launcher decides.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint directory from the session; a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Local runs (tests, bench) without it get a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="loomtext-ckpt-")
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (never local): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def written_table(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back: what is
    stored stays the same in every branch of a plan, and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/loomtext-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# A batch on its way to a Python worker is held by Spark, and two of them by the worker.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "8388608b")


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the cluster or the session has set a value."""
    key, size = BATCH_BYTES
    if key not in spark.conf.getAll:
        spark.conf.set(key, size)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python workers
    can import it wherever the driver was started."""
    bound_batches(spark)
    sc = spark.sparkContext
    if getattr(sc, "_loomtext_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(os.path.join(root, __package__)):
        folder = tempfile.mkdtemp(prefix="loomtext-zip-")  # the driver's own; Spark hands out the file
        path = os.path.join(folder, "loomtext.zip")
        with zipfile.ZipFile(path, "w") as z:
            for base, _, names in os.walk(os.path.join(root, __package__)):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(base, n)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(path)
        if path in sys.path:  # the driver goes on importing from where it was started
            sys.path.remove(path)
    sc._loomtext_shipped = True


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # pragma: no cover - connect sessions
        return int(os.environ.get("BENCH_CPUS", "8"))
