"""Session helpers: a tuned local session for tests and a checkpoint-directory lookup."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager, suppress

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "riskspark") -> SparkSession:
    """Local session used by tests and the bench. On a cluster, use the cluster's own session."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` (or the context's checkpoint dir) when the cluster names one.
    Only a local-mode session without a setting gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="riskspark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


_recorders: list[list[str]] = []
_scratch: dict[str, None] = {}


def at_end_delete(path: str) -> str:
    """Note a scratch table that results may still read: it is deleted when the application ends."""
    _scratch[path] = None
    return path


def delete_table(spark: SparkSession, path: str) -> None:
    """Delete a scratch table now."""
    _scratch.pop(path, None)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _delete_scratch() -> None:
    with suppress(Py4JError, OSError):  # the application may have ended before
        spark = SparkSession.getActiveSession()
        if spark is None or spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
            return
        for path in [*_scratch]:
            delete_table(spark, path)


def materialize(df, name: str):
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and read it back.

    Cuts lineage like a reliable checkpoint and survives executor loss, but computes the plan
    once (an unpersisted eager ``checkpoint()`` computes it twice: for its count and again for
    the checkpoint files), and later readers get column pruning and filter pushdown."""
    spark = df.sparkSession
    path = at_end_delete(f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    if _recorders:
        _recorders[-1].append(path)
    return out


@contextmanager
def temporary_tables(spark: SparkSession):
    """Delete at the end every table that ``materialize`` writes in this block, but those given to the
    function that the block gets."""
    paths: list[str] = []
    _recorders.append(paths)

    def keep(df):
        paths.remove(df._written_to)
        return df

    try:
        yield keep
    finally:
        _recorders.remove(paths)
        for path in paths:
            delete_table(spark, path)
