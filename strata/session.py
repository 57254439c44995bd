"""Session helpers: sensible defaults for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # local mode runs everything in the driver JVM; the 1g default heap thrashes GC
    "spark.driver.memory": os.environ.get("STRATA_DRIVER_MEMORY", "8g"),
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "strata", **conf) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the provided session."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    settings = dict(DEFAULTS)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, each: int = 2 << 20) -> None:
    """Start shuffles with a partition for ``each`` bytes of stored input, so none outgrows its task.

    Adaptive execution joins small neighbours; without it, and in stateful streams, the session's
    ``spark.sql.shuffle.partitions`` holds as before.
    """
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(least, input_bytes // each)))


#: Spark removes the shuffle files of an SQL execution when it ends, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, an execution leaves no shuffle files behind, so a job of many holds those of one on disk."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; a local master without the setting gets a private scratch
    folder, any other master an error, since executors would not share that folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="strata-ckpt-", dir="/tmp")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")
