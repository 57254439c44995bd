"""Silver as a streaming keep-best aggregate, published as versioned snapshots.

A grouped ``max`` has no append output without a watermark, so the aggregate runs in
*complete* mode and each micro-batch result is written by ``foreachBatch`` to its own
folder ``v=<batch id>`` with overwrite. A retried batch rewrites only its own folder
(idempotent); readers take the highest version that finished (``_SUCCESS``).
State is one order struct per key (unbounded in keys): for very large key sets the
batch rebuild (``strata.operators.silver``) is the alternative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators.dedup import keep_best
from strata.operators.entities import Entity
from strata.operators.silver import silver

VERSION_PREFIX = "v="


def start_silver_stream(spark: SparkSession, bronze_path: str, entity: Entity, silver_root: str,
                        checkpoint: str, as_of=None):
    schema = spark.read.parquet(bronze_path).schema
    stream = spark.readStream.schema(schema).parquet(bronze_path)
    best = keep_best(stream, entity)

    def publish(batch: DataFrame, batch_id: int) -> None:
        out = silver(batch, entity, as_of, winners=batch)
        out.write.mode("overwrite").parquet(f"{silver_root}/{VERSION_PREFIX}{batch_id:012d}")

    return (best.writeStream.outputMode("complete")
            .foreachBatch(publish)
            .option("checkpointLocation", checkpoint)
            .queryName(f"silver_{entity.name}")
            .trigger(availableNow=True).start())


def run_silver_stream(spark, bronze_path, entity, silver_root, checkpoint, as_of=None) -> None:
    q = start_silver_stream(spark, bronze_path, entity, silver_root, checkpoint, as_of)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def latest_version(spark: SparkSession, silver_root: str) -> str | None:
    """Path of the newest finished version (driver-side listing of folder names only)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(silver_root)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    done = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith(VERSION_PREFIX) and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            done.append(name)
    return f"{silver_root}/{max(done)}" if done else None


def read_silver(spark: SparkSession, silver_root: str) -> DataFrame:
    path = latest_version(spark, silver_root)
    if path is None:
        raise FileNotFoundError(f"no finished silver version under {silver_root}")
    return spark.read.parquet(path)
