"""Event log of pipeline runs: one nested row per step, stored append-only and never rewritten.

A run reports its start, every stream batch that read rows, every table it wrote (row count and
expectations, observed in the write itself) and its end, with the error if it failed. Events wait
on the driver until ``flush`` appends them as one file; it is called after every ``PENDING`` events
and at the end, also of a run that fails, so the driver holds few events however long the run is.

An event's id is its run and number, so a run id must not be used twice. Numbers rise without gaps
within a run. Events without a table, batch, metrics or error hold NULL there.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

EVENT_SCHEMA = (
    "id string, sequence struct<run_id:string,number:long>, "
    "origin struct<layer:string,table_name:string,batch_id:long>, timestamp timestamp, message string, level string, "
    "maturity_level string, error struct<class_name:string,message:string>, "
    "details struct<rows:long,expectations:array<struct<name:string,passed:long,failed:long>>>, event_type string")
#: Dimensions of the dataset, in order.
DIMENSIONS = ("id", "sequence", "origin", "timestamp", "message", "level", "maturity_level", "error", "details", "event_type")
#: Dimensions that are structs in the table and JSON text in the dataset.
NESTED = ("sequence", "origin", "error", "details")
PENDING = 1000


class EventLog:
    """Events of one run. As a context it reports the run's start and end, and flushes whatever happens."""

    def __init__(self, spark: SparkSession, path: str, run_id: str, as_of: dt.datetime | None = None, maturity: str = "STABLE"):
        self.spark, self.path, self.run_id, self.as_of, self.maturity = spark, path, run_id, as_of, maturity
        self._pending: list[tuple] = []
        self._number = 0
        self._lock = threading.RLock()

    def add(self, event_type: str, message: str, level: str = "INFO", layer: str | None = None, table: str | None = None,
            batch: int | None = None, metrics: Mapping[str, int] | None = None, error: BaseException | None = None) -> None:
        """Report one step; ``metrics`` are the counters of an observed write (see ``observe.observed``)."""
        details = None
        if metrics is not None:
            names = sorted({k.rpartition("__")[0] for k in metrics if "__" in k})
            details = (int(metrics["rows"]), [(n, int(metrics[f"{n}__passed"]), int(metrics[f"{n}__failed"])) for n in names])
            if level == "INFO" and any(failed for _, _, failed in details[1]):
                level = "WARN"
        with self._lock:
            when = self.as_of or dt.datetime.now()
            origin = (layer, table, batch) if table is not None else None
            fault = (type(error).__name__, str(error)) if error is not None else None
            self._pending.append((f"{self.run_id}:{self._number}", (self.run_id, self._number), origin, when, message, level,
                                  self.maturity, fault, details, event_type))
            self._number += 1
            if len(self._pending) >= PENDING:
                self.flush()

    def flush(self) -> None:
        with self._lock:
            if self._pending:
                self.spark.createDataFrame(self._pending, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
                self._pending = []

    def __enter__(self) -> EventLog:
        self.add("create_update", f"Run {self.run_id} started")
        return self

    def __exit__(self, kind, error, trace) -> None:
        if error is None:
            self.add("update_progress", f"Run {self.run_id} completed")
        else:
            self.add("update_progress", f"Run {self.run_id} failed", "ERROR", error=error)
        self.flush()


class BatchEvents(StreamingQueryListener):
    """Rows read by each batch of the streams that run while the listener is registered.

    Batches are told apart by the stream's run, so queries of others in the session are left alone.
    """

    def __init__(self):
        self._rows: dict[str, dict[int, int]] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._change:
            self._rows.setdefault(str(p.runId), {})[p.batchId] = p.numInputRows

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def batches(self, run_id: str, timeout: float = 60.0) -> list[tuple[int, int]]:
        """(batch, rows) of an ended stream run, in order, without empty batches."""
        with self._change:
            if not self._change.wait_for(lambda: run_id in self._ended, timeout):
                raise TimeoutError(f"the end of stream run {run_id} was not reported")
            return sorted((b, n) for b, n in self._rows.get(run_id, {}).items() if n)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The log of all runs, nested; empty where nothing is logged yet."""
    from strata.sources.files import names

    return spark.read.schema(EVENT_SCHEMA).parquet(path) if names(spark, path) else spark.createDataFrame([], EVENT_SCHEMA)


def event_dimensions(events: DataFrame) -> DataFrame:
    """The dataset's ten dimensions, one row an event; nested ones as JSON text without NULL fields."""
    def shown(c: str) -> Column:
        return F.to_json(c).alias(c) if c in NESTED else F.col(c)

    return events.select(*[shown(c) for c in DIMENSIONS])
