"""Incremental bronze -> silver -> gold for transactions, one versioned publish per batch.

A streaming aggregate cannot feed another aggregate in complete mode, so the silver ->
gold hop crosses a table: each micro-batch of the keep-best aggregate (complete mode) is
the full winner set; ``foreachBatch`` turns it into silver and then into gold with batch
operators, joining the *static* merchants table (stream-static joins J1/J2 inside the
batch) and writes every table under ``v=<batch id>``. A retried batch rewrites only its
own version, and readers take the newest finished version of a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators import gold as G
from strata.operators.dedup import keep_best
from strata.operators.entities import TRANSACTIONS
from strata.operators.silver import silver
from strata.streaming.silver import VERSION_PREFIX, latest_version


def _write(df: DataFrame, root: str, table: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{root}/{table}/{VERSION_PREFIX}{batch_id:012d}")


def start_transactions_pipeline(spark: SparkSession, bronze_path: str, merchants_silver_path: str,
                                root: str, checkpoint: str, as_of=None):
    """Start one ``availableNow`` run: bronze transactions stream -> silver + gold versions."""
    schema = spark.read.parquet(bronze_path).schema
    best = keep_best(spark.readStream.schema(schema).parquet(bronze_path), TRANSACTIONS)

    def publish(batch: DataFrame, batch_id: int) -> None:
        merchants = spark.read.parquet(merchants_silver_path)          # static side
        _write(silver(batch, TRANSACTIONS, as_of, winners=batch), root, "transactions_silver", batch_id)
        tx = spark.read.parquet(f"{root}/transactions_silver/{VERSION_PREFIX}{batch_id:012d}")
        channels = G.dim_channel(tx, as_of)
        _write(channels, root, "dim_channel", batch_id)
        _write(G.dim_date(tx, as_of), root, "dim_date", batch_id)
        _write(G.fact_transactions(tx, merchants, None, as_of), root, "fact_transactions", batch_id)

    return (best.writeStream.outputMode("complete").foreachBatch(publish)
            .option("checkpointLocation", checkpoint).queryName("transactions_pipeline")
            .trigger(availableNow=True).start())


def run_transactions_pipeline(spark, bronze_path, merchants_silver_path, root, checkpoint, as_of=None):
    q = start_transactions_pipeline(spark, bronze_path, merchants_silver_path, root, checkpoint, as_of)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_latest(spark: SparkSession, root: str, table: str) -> DataFrame:
    path = latest_version(spark, f"{root}/{table}")
    if path is None:
        raise FileNotFoundError(f"no finished version of {table} under {root}")
    return spark.read.parquet(path)
