"""The driver's TPC-H-like tables and the dirty bronze fixtures derived from them.

``fixture_bronze`` runs the fixture SQL on Spark once per session and sf folder and
stores the result as Parquet bronze tables under the session's checkpoint folder,
exactly like an ingestion run would. Every query then reads bronze with stable row
ids, and the plan below bronze is cut (no re-running of the derivation on retries).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixtures
from strata import vocab
from strata.session import checkpoint_root, shuffles_removed, size_shuffles
from strata.sources.bronze import read_bronze, with_audit, write_bronze

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# pinned load instant for reproducible fixture runs
FIXTURE_AS_OF = dt.datetime(2024, 12, 31, 0, 0, 0)
_LAYOUT_VERSION = "v4"
_WRITE_LOCK = threading.Lock()  # one writer per fixture when queries run concurrently
_FEED_LOCK = threading.Lock()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Temp views named like the driver's tables (for the shared fixture SQL)."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)


def raw_frame(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The raw landing rows of one entity as a lazily derived DataFrame (all strings).

    Orders join by a merge at any size: their Parquet is so small for its rows that Spark's estimate
    would send millions of them through the driver.
    """
    register_tables(spark, sf_dir, fixtures.RAW_INPUTS[entity])
    if "orders" in fixtures.RAW_INPUTS[entity]:
        read_table(spark, sf_dir, "orders").hint("merge").createOrReplaceTempView("orders")
    return spark.sql(fixtures.raw_sql(entity, "spark"))


KEYS = {"transactions": "transaction_id", "users": "user_id", "merchants": "merchant_id"}


def _load_delay(key: str) -> Column:
    """How long before ``FIXTURE_AS_OF`` a fixture row was loaded: 0, 20 or 40 days, by its key's last sign."""
    return F.make_dt_interval(F.lit(20) * F.coalesce(F.ascii(F.substring(key, -1, 1)) % 3, F.lit(0)))


def _bronze_dir(spark: SparkSession, sf_dir: str) -> str:
    """One folder for each state of the input: its path, sizes and times of change."""
    paths = [table_path(sf_dir, t) for t in sorted({t for used in fixtures.RAW_INPUTS.values() for t in used})]
    tag = hashlib.sha1(repr((os.path.abspath(sf_dir), _input_state(spark, paths))).encode()).hexdigest()[:12]
    return f"{checkpoint_root(spark)}/strata-bronze/{_LAYOUT_VERSION}-{tag}"


def fixture_bytes(spark: SparkSession, sf_dir: str, entity: str) -> int:
    return _input_bytes(spark, [table_path(sf_dir, t) for t in fixtures.RAW_INPUTS[entity]])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def _input_state(spark: SparkSession, paths) -> list[tuple[int, int]]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    states = []
    for p in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(p)
        fs = hpath.getFileSystem(conf)
        states.append((fs.getContentSummary(hpath).getLength(), fs.getFileStatus(hpath).getModificationTime()))
    return states


def _input_bytes(spark: SparkSession, paths) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(p)
        total += hpath.getFileSystem(conf).getContentSummary(hpath).getLength()
    return total


def output_files(spark: SparkSession, input_bytes: int, target_bytes: int = 64 << 20) -> int:
    """File count for a derived table: enough for every core to get a split, and files of
    about ``target_bytes`` of input once the data outgrows the cluster's core count."""
    cores = spark.sparkContext.defaultParallelism
    return max(cores, -(-input_bytes // target_bytes))


def spread_files(spark: SparkSession, input_bytes: int) -> int | None:
    """File count for a table whose input is too small to come in enough splits of its own, else None: the rows stay where they are."""
    cores = spark.sparkContext.defaultParallelism
    return cores if input_bytes < cores * (8 << 20) else None


def landed_rows(spark: SparkSession, sf_dir: str, entity: str) -> tuple[DataFrame, int | None]:
    """The rows of an entity's bronze table without row ids, and the count of its files, if it is set."""
    inputs = [table_path(sf_dir, t) for t in fixtures.RAW_INPUTS[entity]]
    landed = with_audit(raw_frame(spark, sf_dir, entity), ",".join(inputs), FIXTURE_AS_OF)
    return landed.withColumn("_ingested_at", F.col("_ingested_at") - _load_delay(KEYS[entity])), spread_files(spark, _input_bytes(spark, inputs))


def fixture_bronze(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Bronze table of one entity for ``sf_dir``, written once, then read with row ids."""
    path = f"{_bronze_dir(spark, sf_dir)}/{entity}"
    size_shuffles(spark, fixture_bytes(spark, sf_dir, "transactions"))
    with _WRITE_LOCK:
        if not _exists(spark, f"{path}/_SUCCESS"):
            landed, files = landed_rows(spark, sf_dir, entity)
            write_bronze(landed, path, files)
    return read_bronze(spark, path)


def fixture_bronzes(spark: SparkSession, sf_dir: str):
    """entity -> bronze DataFrame, each written/read only when first used."""
    from strata.plans.medallion import LazyMap

    return LazyMap({e: (lambda e=e: fixture_bronze(spark, sf_dir, e)) for e in fixtures.RAW_INPUTS})


# ---------------------------------------------------------------- landing files
def fixture_manifest(root: str) -> list:
    """The three landing sources in the original formats, rooted at ``root``."""
    from strata.sources.manifest import SourceSpec

    return [
        SourceSpec("transactions", f"{root}/landing/transactions", "csv", delimiter=",",
                   header=True, multiline=False, partition_by="transaction_date",
                   target_table="bronze.transactions"),
        SourceSpec("users", f"{root}/landing/users", "csv", delimiter="|", header=True,
                   multiline=False, partition_by="country", target_table="bronze.users"),
        SourceSpec("merchants", f"{root}/landing/merchants", "json", delimiter=None,
                   header=None, multiline=True, partition_by="country",
                   target_table="bronze.merchants"),
    ]


def write_fixture_landing(spark: SparkSession, sf_dir: str, root: str, drops: int = 1, sources=None, compression: str | None = None) -> list:
    """Write the raw fixtures as landing files (CSV ',', CSV '|', JSON arrays).

    With ``drops`` > 1 each source is split into that many sub-folders ``drop=<i>``
    (by a hash of the row) so a stream can be fed one drop at a time. ``sources`` names those to write,
    all by default; ``compression`` is that of the CSV files.
    """
    from pyspark.sql import functions as F

    from strata.sources.landing import write_csv, write_json_arrays

    specs = [s for s in fixture_manifest(root) if sources is None or s.source_name in sources]
    for spec in specs:
        raw = raw_frame(spark, sf_dir, spec.source_name)
        for i in range(drops):
            part = raw if drops == 1 else raw.filter(
                F.pmod(F.xxhash64(*raw.columns), F.lit(drops)) == i)
            out = spec.source_path if drops == 1 else f"{spec.source_path}/drop={i}"
            if spec.file_format == "json":
                write_json_arrays(part, out)
            else:
                write_csv(part, out, delimiter=spec.delimiter, header=bool(spec.header), compression=compression)
    return specs


def landing_root(spark: SparkSession, sf_dir: str) -> str:
    return _bronze_dir(spark, sf_dir) + "-landing"


def fixture_ingested(spark: SparkSession, sf_dir: str, sources=tuple(KEYS)) -> dict[str, str]:
    """Landing files of ``sources`` written once per session, then ingested with ``availableNow``.

    Returns table -> bronze path. A second call finds no new files and adds nothing.
    """
    from strata import vocab
    from strata.sources.files import write_marker
    from strata.streaming.ingest import ingest_manifest

    root = landing_root(spark, sf_dir)
    schemas = {"transactions": vocab.TRANSACTIONS_SCHEMA, "users": vocab.USERS_SCHEMA,
               "merchants": vocab.MERCHANTS_SCHEMA}
    size_shuffles(spark, max(fixture_bytes(spark, sf_dir, s) for s in sources))
    with _WRITE_LOCK:
        for source in sources:
            if not _exists(spark, f"{root}/landing/_written-{source}"):
                write_fixture_landing(spark, sf_dir, root, sources=[source], compression="gzip")
                write_marker(spark, f"{root}/landing/_written-{source}", "ok")
        specs = [s for s in fixture_manifest(root) if s.source_name in sources]
        return ingest_manifest(spark, specs, f"{root}/bronze", schemas, FIXTURE_AS_OF)


# ---------------------------------------------------------------- drops for the incremental tables
DROPS = 4


def write_drops(spark: SparkSession, sf_dir: str, entity: str, folder: str, drops: int = DROPS) -> None:
    """An entity's bronze rows as ``folder/drop=<i>``, the parts that arrive with each drop, by a hash of the row id.

    They are derived and written once, with no bronze table beside them.
    """
    from strata.sources.files import exists

    size_shuffles(spark, fixture_bytes(spark, sf_dir, "transactions"))
    landed, files = landed_rows(spark, sf_dir, entity)
    rows = (landed.repartition(files) if files else landed).withColumn(vocab.ROW_ID, F.monotonically_increasing_id())
    part = F.pmod(F.xxhash64(F.lit("drop"), vocab.ROW_ID), F.lit(drops)).alias("drop")
    with shuffles_removed(spark):
        rows.select("*", part).write.mode("overwrite").option("compression", "zstd").partitionBy("drop").parquet(folder)
    for drop in range(drops):
        if not exists(spark, f"{folder}/drop={drop}"):  # one without rows arrives, too
            spark.createDataFrame([], rows.schema).write.parquet(f"{folder}/drop={drop}")


def bucket_count(input_bytes: int) -> int:
    """Buckets of an entity's keyed tables: they hold about the same however large the input is."""
    return max(4, input_bytes >> 25)


def fixture_incremental(spark: SparkSession, sf_dir: str, names=tuple(KEYS)) -> dict[str, str]:
    """Name -> root of the incremental tables of entities, fed drop by drop with a fold in between.

    Made once for each entity and state of the input; an attempt that failed is never read. Drops wait in ``waiting``,
    are moved to where the stream looks as they arrive, and go once their batch is in the tables.
    """
    import uuid

    from strata.operators.entities import ENTITIES
    from strata.sources.files import delete, exists, move, read_text, write_marker
    from strata.streaming.incremental import fold, start_incremental

    base = _bronze_dir(spark, sf_dir) + "-incremental"
    with _FEED_LOCK:
        missing = [n for n in names if not exists(spark, f"{base}/{n}.txt")]
        if missing:
            root = f"{base}/{uuid.uuid4().hex}"
            buckets = {n: bucket_count(fixture_bytes(spark, sf_dir, n)) for n in missing}
            for n in missing:
                write_drops(spark, sf_dir, n, f"{root}/waiting/{n}")
            for drop in range(DROPS):
                running = []
                for n in missing:
                    move(spark, f"{root}/waiting/{n}/drop={drop}", f"{root}/bronze/{n}/drop-{drop}")
                    running.append(start_incremental(spark, f"{root}/bronze/{n}/drop-*", ENTITIES[n], f"{root}/{n}", f"{root}/checkpoints/{n}", FIXTURE_AS_OF, buckets=buckets[n]))
                for q in running:
                    q.awaitTermination()
                    if q.exception() is not None:
                        raise q.exception()
                for n in missing:
                    delete(spark, f"{root}/bronze/{n}/drop-{drop}")
                if drop == 1:
                    for n in missing:
                        fold(spark, f"{root}/{n}", buckets=buckets[n])
            for n in missing:
                write_marker(spark, f"{base}/{n}.txt", f"{root}/{n}")
        return {n: read_text(spark, f"{base}/{n}.txt").strip() for n in names}


# ---------------------------------------------------------------- a whole job, and days closed by a stream
def fixture_job(spark: SparkSession, sf_dir: str) -> str:
    """Lake root of one whole job over the landing files; run once for each state of the input."""
    import uuid

    from strata import vocab
    from strata.plans.job import run_job
    from strata.sources.files import exists, read_text, write_marker

    base = _bronze_dir(spark, sf_dir) + "-job"
    schemas = {"transactions": vocab.TRANSACTIONS_SCHEMA, "users": vocab.USERS_SCHEMA, "merchants": vocab.MERCHANTS_SCHEMA}
    with _FEED_LOCK:
        if not exists(spark, f"{base}/current.txt"):
            root = f"{base}/{uuid.uuid4().hex}"
            run_job(spark, write_fixture_landing(spark, sf_dir, root), f"{root}/lake", schemas, FIXTURE_AS_OF, run_id="fixture")
            write_marker(spark, f"{base}/current.txt", f"{root}/lake")
        return read_text(spark, f"{base}/current.txt").strip()


def fixture_closed_days(spark: SparkSession, sf_dir: str, stored, drops: int = 3) -> str:
    """Root of a fact whose days a stream closes, fed silver in drops that each hold rows of all days.

    The first drop closes nearly all days, so most rows of the others are late. Repairs run after
    the second and the last drop.
    """
    import uuid

    from strata.sources.files import exists, read_text, write_marker
    from strata.streaming.repair import CLOSED, repair_closed_days, run_closed_groups

    base = _bronze_dir(spark, sf_dir) + "-closed"
    tx = stored["transactions_silver"]
    with _FEED_LOCK:
        if not exists(spark, f"{base}/current.txt"):
            root = f"{base}/{uuid.uuid4().hex}"
            for drop in range(drops):
                part = tx.where(F.pmod(F.xxhash64(F.lit("late"), "transaction_id"), F.lit(drops)) == drop)
                part.write.mode("overwrite").parquet(f"{root}/landing/drop={drop}")
                stream = spark.readStream.schema(tx.schema).parquet(f"{root}/landing/drop=*")
                run_closed_groups(stream, f"{root}/{CLOSED}", f"{root}/checkpoint", "1 day")
                if drop:
                    repair_closed_days(spark, root, spark.read.parquet(f"{root}/landing").drop("drop"))
            write_marker(spark, f"{base}/current.txt", root)
        return read_text(spark, f"{base}/current.txt").strip()
