"""Session helpers: library settings for a session that leaves them open, and
the shared checkpoint folder used to cut lineage."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings that the library assumes; a session that names one keeps its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_memory() -> str:
    """Heap of a local session: two fifths of the machine's memory, 1 to 16 GB; the rest is for Python workers."""
    total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") if hasattr(os, "sysconf") else 8 << 30
    return f"{min(16 << 10, max(1 << 10, total * 2 // 5 >> 20))}m"


def get_spark(master: str | None = None, app: str = "pulsekit",
              shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session.

    On a cluster call it without arguments: master, memory and shuffle
    partitions then come from spark-submit, and only those of ``DEFAULTS`` that
    the session does not set are filled in.  Tests and the bench pass a
    local master.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = (b.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", driver_memory or local_memory()))
    spark = b.getOrCreate()
    given = spark.sparkContext.getConf()
    wanted = DEFAULTS | ({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {})
    for key, value in wanted.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    if master:
        spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Where a cluster session names none, this is an error: a folder made up here
    would lie on one machine only.  A local session (all tasks in one process) gets its own.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pulsekit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and broadcasts of finished steps.

    It does so for those that a garbage collection of the driver finds unused; left alone, the next full one
    may be half an hour away.  Python's own comes first: frames that Python has dropped hang in cycles of Py4J
    objects, and until those go the JVM's side stays in use.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Spark's setting to delete a query's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Writes in here delete the shuffle files of their own steps when they end: nothing reads those again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet among the shared checkpoints and read back: columns, compressed, where rows are many.

    Shuffle files of the write go as soon as it ends.
    """
    at = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{df.sparkSession.sparkContext.applicationId}/{uuid.uuid4().hex}"
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def cut_lineages(*frames: DataFrame) -> list[DataFrame]:
    """``cut_lineage`` of several small results, as concurrent jobs: none of them alone fills a cluster."""
    if not frames:
        return []
    ensure_checkpoint_dir(frames[0].sparkSession)
    with ThreadPoolExecutor(max_workers=min(8, len(frames))) as pool:
        return list(pool.map(cut_lineage, frames))
