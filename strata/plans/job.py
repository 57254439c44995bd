"""The end-to-end job: incremental ingest of every active source, then all layers.

Step 1 runs each manifest entry with ``availableNow`` into its bronze table (new files
only). Step 2 rebuilds silver, quarantine, gap reports and gold from bronze and writes
them with the gold snapshots and the run log (``plans.publish``). Both steps are plain
Spark jobs, so retries and lost executors are handled by Spark and the checkpoints.

Usage: ``python -m strata.plans.job <manifest.json> <lake root>`` (schemas come from the
manifest's ``schema_location`` files).
"""

from __future__ import annotations

import sys
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import vocab
from strata.operators.entities import ENTITIES
from strata.plans.events import EventLog
from strata.plans.medallion import build
from strata.plans.publish import new_run_id, publish
from strata.sources.bronze import read_bronze, with_audit
from strata.sources.manifest import SourceSpec, load_manifest
from strata.streaming.ingest import ingest_manifest

#: Folder of the event log below a lake's root.
EVENT_LOG = "observability/event_log"


def run_job(spark: SparkSession, specs: Iterable[SourceSpec], root: str, schemas=None, as_of=None,
            writer_groups: Iterable[str] = (), run_id: str | None = None) -> dict[str, DataFrame]:
    """Ingest what is active, then publish all entities as one version.

    An entity whose source is inactive keeps its rows of earlier runs, or has none; sources that
    are no entity are ingested into bronze only. The steps, and the error of a run that fails, are
    appended to ``observability/event_log`` (see ``plans.events``).
    """
    run_id = run_id or new_run_id()
    with EventLog(spark, f"{root}/{EVENT_LOG}", run_id, as_of) as events:
        ingest_manifest(spark, list(specs), f"{root}/bronze", schemas, as_of, events=events)
        bronze = {name: landed(spark, f"{root}/bronze/{name}", ENTITIES[name].columns) for name in ENTITIES}
        return publish(build(bronze, as_of, writer_groups), root, as_of, writer_groups, run_id=run_id, events=events)


def landed(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """The bronze table at ``path``; without one, or one without rows yet, an empty frame of its form."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hadoop) and any(not s.getPath().getName().startswith("_") for s in fs.listStatus(hadoop)):
        return read_bronze(spark, path)
    empty = with_audit(spark.createDataFrame([], vocab.string_schema(columns)), "")
    return empty.withColumn(vocab.ROW_ID, F.monotonically_increasing_id())


def main(argv: list[str]) -> None:
    from strata.session import get_spark

    manifest, root = argv[1], argv[2]
    spark = SparkSession.getActiveSession() or get_spark()
    stored = run_job(spark, load_manifest(manifest), root)
    for name, df in sorted(stored.items()):
        if name != "run_log":
            print(name, df.count())


if __name__ == "__main__":
    main(sys.argv)
