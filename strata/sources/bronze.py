"""Bronze tables: raw landing rows as strings plus audit columns, stored as Parquet.

Reading bronze attaches ``_row_id`` = (file path, row index inside the file), taken
from Spark's hidden ``_metadata`` column. It is unique and identical on every
re-execution of a task, which is what lets the dedup flag duplicates with a uniform
anti join instead of a per-key window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import vocab
from strata.functions.stamps import load_timestamp


#: Prefix of the folder columns of a partitioned table; the column itself stays in the files.
PARTITION = "_part_"


def row_id() -> Column:
    """(file path, row index): unique, and the same on every re-execution of a task."""
    return F.struct(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.row_index").alias("row"))


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Bronze Parquet table with its stable ``_row_id``.

    A table written whole by ``write_bronze`` stores a compact id (one long); one appended by the
    ingest stream gets its exact id from ``_metadata``. A partitioned table reads like a flat one:
    folder values only prune, since a folder name cannot tell an empty text from NULL or a
    date from a text.
    """
    df = spark.read.parquet(path)
    if vocab.ROW_ID not in df.columns:
        df = df.select("*", row_id().alias(vocab.ROW_ID))
    return df.drop(*[c for c in df.columns if c.startswith(PARTITION)])


def partitioned(df: DataFrame, column: str) -> tuple[DataFrame, str]:
    """``df`` with a folder column for ``column``, and that column's name."""
    return df.withColumn(PARTITION + column, F.col(column)), PARTITION + column


def write_bronze(df: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite a bronze table, storing a compact unique ``_row_id``.

    ``monotonically_increasing_id`` is unique within one job (partition index in the high
    bits) and, once written, fixed: later reads and task retries see the stored value.
    Being a long instead of a path string, it keeps the dedup shuffles narrow.
    """
    if files:
        df = df.repartition(files)
    df.withColumn(vocab.ROW_ID, F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)


def with_audit(df: DataFrame, source_file: Column | str | None = None,
               as_of: dt.datetime | dt.date | str | None = None) -> DataFrame:
    """Append the bronze audit columns.

    ``_ingested_at`` and ``_pipeline_run_id`` are the load instant (both timestamps);
    ``_source_file`` is the landing file path (``_metadata.file_path`` by default).
    """
    if source_file is None:
        source_file = F.col("_metadata.file_path")
    elif isinstance(source_file, str):
        source_file = F.lit(source_file)
    stamp = load_timestamp(as_of)
    return df.select("*", stamp.alias("_ingested_at"), source_file.alias("_source_file"),
                     stamp.alias("_pipeline_run_id"))


def data_columns(df: DataFrame) -> list[str]:
    """Bronze columns as stored (landing columns + audit), without helper columns."""
    return [c for c in df.columns if c != vocab.ROW_ID and not c.startswith("_dup")]
