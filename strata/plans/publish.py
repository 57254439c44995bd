"""Publishing layers as whole versions: new folders first, then one marker for all tables.

Every run writes below its own version folder and nothing is overwritten. The set becomes visible
by one marker, written last; a run that fails leaves the marker of the version before, so readers
always see one consistent set. Every write goes below a root the caller passes (on a cluster a
shared folder), and a written table cuts lineage: a lost executor re-reads files.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from strata.operators.entities import ENTITIES
from strata.operators.observe import expectations, observed, run_log
from strata.operators.policies import MEMBER_SCHEMA, POLICY_SCHEMA, member_rows, policy_rows, secure_table
from strata.operators.silver import silver
from strata.plans.events import EventLog
from strata.plans.medallion import SILVER_NAMES, Layers

GOLD_SNAPSHOTS = ("fact_transactions", "dim_merchant", "dim_user", "dim_channel", "dim_date")


def materialize(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Overwrite ``path`` with ``df`` and return the stored table (a materialized view)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def new_run_id() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return hadoop, hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _mark(spark: SparkSession, root: str, run_id: str, tables: dict[str, str]) -> None:
    """Make a version visible: a file that appears whole, by a rename."""
    hadoop, fs = _filesystem(spark, root)
    part, marker = hadoop(f"{root}/_published/.{run_id}.part"), hadoop(f"{root}/_published/{run_id}.json")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(tables).encode()))
    out.close()
    if not fs.rename(part, marker):
        raise OSError(f"cannot publish {marker}: a run of this id was published before")


def versions(spark: SparkSession, root: str) -> list[str]:
    """Ids of the published versions, oldest first."""
    hadoop, fs = _filesystem(spark, root)
    if not fs.exists(hadoop(f"{root}/_published")):
        return []
    seen = [(s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(hadoop(f"{root}/_published"))]
    return [name.removesuffix(".json") for _, name in sorted(seen) if name.endswith(".json") and not name.startswith(".")]


def write_policies(policies: DataFrame, members: DataFrame, root: str) -> None:
    """Replace the lake's policies and group memberships; readers follow with their next plan."""
    policies.coalesce(1).write.mode("overwrite").parquet(f"{root}/_policies/rules")
    members.coalesce(1).write.mode("overwrite").parquet(f"{root}/_policies/members")


def read_policies(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The lake's policies and memberships; those of the silver users and no member where none are written."""
    hadoop, fs = _filesystem(spark, root)
    if not fs.exists(hadoop(f"{root}/_policies/members/_SUCCESS")):
        return policy_rows(spark), member_rows(spark)
    return (spark.read.schema(POLICY_SCHEMA).parquet(f"{root}/_policies/rules"),
            spark.read.schema(MEMBER_SCHEMA).parquet(f"{root}/_policies/members"))


def read_lake(spark: SparkSession, root: str, reader: str | None = None, run_id: str | None = None) -> dict[str, DataFrame]:
    """What ``reader`` sees of one published version, the newest by default.

    Every table passes the lake's policies; without a reader it is what one in no group sees.
    """
    policies, members = read_policies(spark, root)
    return {name: secure_table(df, name, policies, members, reader) for name, df in owner_tables(spark, root, run_id).items()}


def owner_tables(spark: SparkSession, root: str, run_id: str | None = None) -> dict[str, DataFrame]:
    """The stored tables of one published version, for the jobs that own the lake: no policy applies."""
    known = versions(spark, root)
    if not known:
        raise FileNotFoundError(f"nothing is published below {root}")
    hadoop, fs = _filesystem(spark, root)
    marker = spark.read.text(f"{root}/_published/{run_id or known[-1]}.json", wholetext=True).first()[0]
    return {name: spark.read.parquet(path) for name, path in json.loads(marker).items()}


def remove_versions(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete all published versions but the newest ``keep``, marker first; returns their ids."""
    old = versions(spark, root)[: -keep or None]
    hadoop, fs = _filesystem(spark, root)
    for run_id in old:
        fs.delete(hadoop(f"{root}/_published/{run_id}.json"), False)
        fs.delete(hadoop(f"{root}/versions/{run_id}"), True)
    return old


def publish(layers: Layers, root: str, as_of=None, writer_groups: Iterable[str] = (),
            snapshots: bool = True, run_id: str | None = None, events: EventLog | None = None) -> dict[str, DataFrame]:
    """Write winners (staging), silver, gap reports, quarantine, gold and gold snapshots.

    The dedup winners are written once and re-read, so silver, quarantine and the gap
    report do not each recompute the dedup aggregate; gold reads the stored silver.
    Row counts and silver expectations are observed during the writes themselves and
    appended to ``observability/run_log``. Everything lies below ``versions/<run id>`` and is
    seen by ``read_lake`` only once all of it is written. ``events`` gets one event per table.
    Returns table name -> stored DataFrame.
    """
    spark = next(iter(layers.bronze.values())).sparkSession
    run_id = run_id or new_run_id()
    checks = expectations()
    log: list[tuple[str, str, dict]] = []
    base, root = root, f"{root}/versions/{run_id}"
    paths: dict[str, str] = {}

    def write(df: DataFrame, layer: str, table: str, path: str) -> DataFrame:
        paths[table] = path
        df, obs = observed(df, f"{run_id}:{table}", checks.get(table, ()))
        out = materialize(df, path)
        log.append((layer, table, obs.get))
        if events is not None:
            events.add("flow_progress", f"{obs.get['rows']} rows written to {table}", layer=layer, table=table, metrics=obs.get)
        return out

    stored: dict[str, DataFrame] = {}
    winners = {n: materialize(layers.winners[n], f"{root}/staging/{n}_winners") for n in layers.bronze}
    silvers = {}
    for n, raw in layers.bronze.items():
        silvers[n] = stored[SILVER_NAMES[n]] = write(
            silver(raw, ENTITIES[n], as_of, winners=winners[n]), "Silver", SILVER_NAMES[n],
            f"{root}/silver/{SILVER_NAMES[n]}")
    out = Layers(layers.bronze, as_of, writer_groups, winners=winners, silver_tables=silvers)
    for n in layers.bronze:
        stored[f"unaccounted_{n}"] = write(out.unaccounted[n], "Silver", f"unaccounted_{n}",
                                           f"{root}/silver/unaccounted_{n}")
    stored["quarantine"] = write(out.quarantine, "Silver", "quarantine", f"{root}/silver/quarantine")
    for name, df in out.gold.items():
        stored[name] = write(df, "Gold", name, f"{root}/gold/{name}")
    if snapshots:
        for name in GOLD_SNAPSHOTS:
            stored[f"mv_{name}"] = write(stored[name], "Gold", f"mv_{name}", f"{root}/gold/mv_{name}")
    run_log(spark, run_id, log).write.mode("append").parquet(f"{base}/observability/run_log")
    _mark(spark, base, run_id, paths)
    stored["run_log"] = spark.read.parquet(f"{base}/observability/run_log")
    return stored


def register_views(stored: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Expose published tables to SQL as temporary views (``<prefix><table name>``)."""
    names = []
    for name, df in stored.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
