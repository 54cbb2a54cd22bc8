"""Session construction and the shared scratch location.

On a cluster the session comes from ``spark-submit`` and already names
``spark.checkpoint.dir`` (a shared, fault-tolerant folder). We only read
it. A private default is set only when it is missing (local tests).
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that hold for every deployment size: AQE re-plans joins and
# coalesces shuffle partitions at runtime, and splits skewed join keys.
_SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Long-running jobs (streaming with matrix reloads) drop checkpoint files
    # of RDDs that are no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Written tables that have not been released yet.
_scratch: list[str] = []


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "reelrank", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the scale defaults applied.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    pass neither and let spark-submit decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _SCALE_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        # Tests and single-machine runs only: a cluster names a shared folder.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="reelrank-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint location for written tables."""
    base = ensure_checkpoint_dir(spark)
    # The checkpoint dir carries a per-application uuid suffix; write beside it.
    path = os.path.join(base.rstrip("/"), "reelrank", f"{name}-{uuid.uuid4().hex}")
    _scratch.append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the written tables that this driver has made so far; how many.

    For the owner of the results: call it when every DataFrame that reads
    them has been written or collected (a job's end, between two queries of a
    benchmark). Queries themselves return lazy results and must not.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = list(_scratch)
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
        _scratch.remove(path)
    return len(paths)


def materialize_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the checkpoint location and read it back.

    For inputs a plan reads several times: every later read is a pruned
    columnar scan of the written table (no recomputation, short lineage, and
    the files survive executor loss), unlike an RDD checkpoint whose rows are
    read whole.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries run inside delete their shuffle files when they end.

    For loops of many queries, whose files would otherwise lie on the disks
    until the driver happens to collect garbage.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpoint_once(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` into the checkpoint folder, computed once.

    An eager ``checkpoint()`` runs the plan for its count and again for the
    job that writes the checkpoint files; persisting first (memory and disk)
    lets the write read the cached blocks. The cache is dropped afterwards;
    the result reads the checkpoint files and has a cut lineage.
    """
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()
