"""Bronze ingestion as an incremental file stream with ``availableNow`` triggers.

Each run picks up only files not seen before (tracked in the checkpoint), appends them
to the bronze Parquet table and stops. Re-running with no new file adds nothing; a
retried micro-batch is deduplicated by the file sink's commit log.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.sources.bronze import partitioned, with_audit
from strata.sources.landing import read_landing
from strata.sources.manifest import SourceSpec, active_specs, load_schema, schema_from_mapping


def bronze_stream(spark: SparkSession, spec: SourceSpec, schema=None,
                  as_of: dt.datetime | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Streaming DataFrame of landing rows plus audit columns."""
    if schema is None:
        schema = load_schema(spec.schema_location)
    elif not hasattr(schema, "fields"):
        schema = schema_from_mapping(schema)
    bound = {"maxFilesPerTrigger": files_per_batch} if files_per_batch else {}
    return with_audit(read_landing(spark, spec, schema, stream=True, **bound), None, as_of)


def start_ingest(spark: SparkSession, spec: SourceSpec, bronze_path: str, schema=None,
                 checkpoint: str | None = None, as_of=None,
                 partition_by: bool = False, files_per_batch: int | None = None) -> StreamingQuery:
    """Start one ``availableNow`` run of a source into its bronze table.

    ``files_per_batch`` cuts a backlog into several micro-batches, so a failure repeats only one.
    """
    checkpoint = checkpoint or spec.checkpoint_path or f"{bronze_path}/_checkpoint"
    rows, folder = bronze_stream(spark, spec, schema, as_of, files_per_batch), None
    if partition_by and spec.partition_by:
        rows, folder = partitioned(rows, spec.partition_by)
    writer = (rows.writeStream
              .format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint)
              .queryName(f"bronze_{spec.table_name}")
              .trigger(availableNow=True))
    if folder:
        writer = writer.partitionBy(folder)
    return writer.start(bronze_path)


def ingest_manifest(spark: SparkSession, specs, bronze_root: str, schemas=None, as_of=None,
                    declared: bool = False, files_per_batch: int | None = None, events=None) -> dict[str, str]:
    """Run every active manifest entry; returns table name -> bronze path.

    The runs are started together so the sources ingest concurrently; if one fails, the others are
    stopped. With ``declared`` the manifest's own checkpoint path and partition column are used,
    else checkpoints lie below ``bronze_root`` and tables are flat. ``events`` (an ``EventLog``) gets one
    event per batch that read rows, source by source.
    """
    schemas = schemas or {}
    paths, queries = {}, []
    listener = None
    if events is not None:
        from strata.plans.events import BatchEvents

        listener = BatchEvents()
        spark.streams.addListener(listener)
    try:
        for spec in active_specs(specs):
            path = f"{bronze_root}/{spec.table_name}"
            paths[spec.table_name] = path
            checkpoint = declared and spec.checkpoint_path or f"{bronze_root}/_checkpoints/{spec.table_name}"
            queries.append(start_ingest(spark, spec, path, schemas.get(spec.source_name), checkpoint, as_of,
                                        partition_by=declared, files_per_batch=files_per_batch))
        for q in queries:
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
        if listener is not None:
            for table, q in zip(paths, queries):
                for batch, rows in listener.batches(str(q.runId)):
                    events.add("flow_progress", f"{rows} rows read into {table}", layer="Bronze", table=table, batch=batch, metrics={"rows": rows})
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
        if listener is not None:
            spark.streams.removeListener(listener)
    return paths
