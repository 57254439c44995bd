"""Stream = batch: landing files arrive in drops; each availableNow run catches up."""

import datetime as dt

from pyspark.sql import functions as F

from strata import vocab
from strata.operators.entities import MERCHANTS, TRANSACTIONS
from strata.operators.silver import silver
from strata.sources.bronze import read_bronze
from strata.sources.landing import publish_files, write_csv, write_json_arrays
from strata.sources.testdata import fixture_manifest, raw_frame
from strata.streaming.fact import daily_fact, late_rows, read_daily_fact, start_closed_days, start_daily_fact
from strata.streaming.ingest import ingest_manifest
from strata.streaming.silver import latest_version, read_silver, run_silver_stream
from tests.conftest import SF_SMALL
from tests.helpers import multiset

AS_OF = dt.datetime(2024, 12, 31)
SCHEMAS = {"transactions": vocab.TRANSACTIONS_SCHEMA, "users": vocab.USERS_SCHEMA,
           "merchants": vocab.MERCHANTS_SCHEMA}


def rows(df, cols):
    return multiset(cols, [tuple(r) for r in df.select(*cols).collect()])


def test_ingest_and_silver_stream_equal_batch(spark, scratch):
    specs = fixture_manifest(f"{scratch}/src")
    drops = 3
    raws = {s.source_name: raw_frame(spark, SF_SMALL, s.source_name) for s in specs}
    for s in specs:
        raw = raws[s.source_name]
        for i in range(drops):
            part = raw.filter(F.pmod(F.xxhash64(*raw.columns), F.lit(drops)) == i)
            out = f"{scratch}/staged/{s.source_name}/{i}"
            if s.file_format == "json":
                write_json_arrays(part, out)
            else:
                write_csv(part, out, delimiter=s.delimiter, header=True)

    bronze_root = f"{scratch}/bronze"
    seen = {n: 0 for n in raws}
    for i in range(drops):
        for s in specs:
            publish_files(spark, f"{scratch}/staged/{s.source_name}/{i}", s.source_path, f"d{i}-")
        paths = ingest_manifest(spark, specs, bronze_root, SCHEMAS, AS_OF)
        for s in specs:
            raw = raws[s.source_name]
            seen[s.source_name] = raw.filter(
                F.pmod(F.xxhash64(*raw.columns), F.lit(drops)) <= i).count()
            bronze = spark.read.parquet(paths[s.table_name])
            assert bronze.count() == seen[s.source_name]
            assert bronze.filter(F.col("_source_file").isNull()).count() == 0

        run_silver_stream(spark, paths["transactions"], TRANSACTIONS, f"{scratch}/silver_tx",
                          f"{scratch}/ckpt/silver_tx", AS_OF)
        streamed = read_silver(spark, f"{scratch}/silver_tx")
        batch = silver(read_bronze(spark, paths["transactions"]), TRANSACTIONS, AS_OF)
        cols = list(TRANSACTIONS.silver_columns)
        assert rows(streamed, cols) == rows(batch, cols)

    # all landing rows arrived exactly once, with their values
    for s in specs:
        landed = spark.read.parquet(paths[s.table_name]).select(*raws[s.source_name].columns)
        assert rows(landed, landed.columns) == rows(raws[s.source_name], landed.columns)

    # a run with no new file changes nothing
    before = latest_version(spark, f"{scratch}/silver_tx")
    paths = ingest_manifest(spark, specs, bronze_root, SCHEMAS, AS_OF)
    run_silver_stream(spark, paths["transactions"], TRANSACTIONS, f"{scratch}/silver_tx",
                      f"{scratch}/ckpt/silver_tx", AS_OF)
    assert latest_version(spark, f"{scratch}/silver_tx") == before
    for s in specs:
        assert spark.read.parquet(paths[s.table_name]).count() == seen[s.source_name]


def _fact_drops(spark, scratch):
    """Silver transactions in three drops that are out of order; every drop holds rows without a date."""
    bronze = {n: raw_frame(spark, SF_SMALL, n) for n in ("transactions", "merchants")}
    tx, merchants = silver(bronze["transactions"], TRANSACTIONS, AS_OF), silver(bronze["merchants"], MERCHANTS, AS_OF)
    late, part = F.col("transaction_date") < F.lit(dt.date(2024, 3, 1)), F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    drop = F.when(late & (part != 1), 2).otherwise(part)  # most old rows come last
    for k in range(3):
        tx.filter(drop == k).write.parquet(f"{scratch}/tx/{k}")
        assert spark.read.parquet(f"{scratch}/tx/{k}").filter("transaction_date IS NULL").count() > 0
    return merchants


def test_daily_fact_stream_equals_batch_in_every_row(spark, scratch):
    merchants = _fact_drops(spark, scratch)
    landing, out, ckpt = f"{scratch}/tx_stream", f"{scratch}/fact_out", f"{scratch}/fact_ckpt"
    schema = spark.read.parquet(f"{scratch}/tx/0").schema
    for k in range(3):
        publish_files(spark, f"{scratch}/tx/{k}", landing, f"{k}-")
        q = start_daily_fact(spark.readStream.schema(schema).parquet(landing), out, ckpt)
        q.awaitTermination()
        assert q.exception() is None
        expected, got = daily_fact(spark.read.parquet(landing), merchants), read_daily_fact(spark, out, merchants)
        assert sorted(rows(got, expected.columns), key=str) == sorted(rows(expected, expected.columns), key=str)


def test_closed_days_are_opt_in_and_count_what_they_drop(spark, scratch):
    merchants = _fact_drops(spark, scratch)
    landing, lost = f"{scratch}/tx_stream", 0
    schema = spark.read.parquet(f"{scratch}/tx/0").schema
    for k in range(3):
        publish_files(spark, f"{scratch}/tx/{k}", landing, f"{k}-")
        q = start_closed_days(spark.readStream.schema(schema).parquet(landing), merchants, f"{scratch}/closed", f"{scratch}/closed_ckpt", "1 day")
        q.awaitTermination()
        assert q.exception() is None
        lost += late_rows(q)
    assert lost > 0


def test_transactions_pipeline_stream_equals_batch(spark, scratch):
    from strata.operators import gold as G
    from strata.sources.bronze import write_bronze
    from strata.streaming.pipeline import read_latest, run_transactions_pipeline

    write_bronze(raw_frame(spark, SF_SMALL, "merchants"), f"{scratch}/bronze_m")
    merchants = silver(read_bronze(spark, f"{scratch}/bronze_m"), MERCHANTS, AS_OF)
    merchants.write.parquet(f"{scratch}/merchants_silver")
    merchants = spark.read.parquet(f"{scratch}/merchants_silver")

    tx_raw = raw_frame(spark, SF_SMALL, "transactions")
    for i in range(2):   # bronze grows by two appends; one availableNow run after each
        tx_raw.filter(F.pmod(F.xxhash64(*tx_raw.columns), F.lit(2)) == i) \
              .write.mode("append").parquet(f"{scratch}/bronze_tx")
        run_transactions_pipeline(spark, f"{scratch}/bronze_tx", f"{scratch}/merchants_silver",
                                  f"{scratch}/lake", f"{scratch}/ckpt", AS_OF)
        tx = silver(read_bronze(spark, f"{scratch}/bronze_tx"), TRANSACTIONS, AS_OF)
        expected = {"transactions_silver": tx, "dim_channel": G.dim_channel(tx, AS_OF),
                    "dim_date": G.dim_date(tx, AS_OF),
                    "fact_transactions": G.fact_transactions(tx, merchants, None, AS_OF)}
        for table, want in expected.items():
            got = read_latest(spark, f"{scratch}/lake", table)
            assert rows(got, want.columns) == rows(want, want.columns), (i, table)


def test_dimensions_run_on_streams(spark, scratch):
    """dim_channel / dim_date (streaming distinct) and the pass-through dims in append mode."""
    from strata.operators import gold as G

    bronze = {n: raw_frame(spark, SF_SMALL, n) for n in ("transactions", "users", "merchants")}
    from strata.operators.entities import USERS

    silvers = {"transactions": silver(bronze["transactions"], TRANSACTIONS, AS_OF),
               "users": silver(bronze["users"], USERS, AS_OF),
               "merchants": silver(bronze["merchants"], MERCHANTS, AS_OF)}
    for n, df in silvers.items():
        df.write.parquet(f"{scratch}/silver/{n}")
    streams = {n: spark.readStream.schema(df.schema).parquet(f"{scratch}/silver/{n}")
               for n, df in silvers.items()}
    cases = {
        "dim_channel": (G.dim_channel(streams["transactions"], AS_OF), G.dim_channel(silvers["transactions"], AS_OF)),
        "dim_date": (G.dim_date(streams["transactions"], AS_OF), G.dim_date(silvers["transactions"], AS_OF)),
        "dim_merchant": (G.dim_merchant(streams["merchants"], AS_OF), G.dim_merchant(silvers["merchants"], AS_OF)),
        "dim_user": (G.dim_user(streams["users"], (), AS_OF), G.dim_user(silvers["users"], (), AS_OF)),
    }
    for name, (stream, batch) in cases.items():
        q = (stream.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{scratch}/ckpt/{name}")
             .trigger(availableNow=True).start(f"{scratch}/out/{name}"))
        q.awaitTermination()
        got = spark.read.parquet(f"{scratch}/out/{name}")
        assert rows(got, batch.columns) == rows(batch, batch.columns), name


def test_documented_streaming_refusals(spark, scratch):
    """Append mode is refused for the keep-best aggregate and for a fact keyed by the date."""
    import pytest
    from pyspark.errors import AnalysisException

    from strata.operators.dedup import keep_best

    raw = raw_frame(spark, SF_SMALL, "transactions")
    raw.write.parquet(f"{scratch}/b")
    stream = spark.readStream.schema(raw.schema).parquet(f"{scratch}/b")
    with pytest.raises(AnalysisException):
        keep_best(stream, TRANSACTIONS).writeStream.outputMode("append").format("memory") \
            .queryName("refused_dedup").option("checkpointLocation", f"{scratch}/c1").start()
    ts = stream.withColumn("transaction_ts", F.to_timestamp("transaction_date")) \
               .withWatermark("transaction_ts", "1 day")
    by_date = ts.groupBy(F.to_date("transaction_ts").alias("d")).count()
    with pytest.raises(AnalysisException):
        by_date.writeStream.outputMode("append").format("memory").queryName("refused_fact") \
            .option("checkpointLocation", f"{scratch}/c2").start()


def test_replayed_batch_does_not_duplicate(spark, scratch):
    """A crash after a batch wrote its output but before its commit: the batch id is replayed
    on restart. The Parquet sink skips it (its own log has the batch) and the versioned
    silver rewrites the same folder, so nothing is duplicated."""
    import os
    import shutil

    from strata.sources.testdata import write_fixture_landing
    from strata.streaming.ingest import start_ingest

    specs = {s.source_name: s for s in write_fixture_landing(spark, SF_SMALL, f"{scratch}/src")}
    tx = specs["transactions"]
    bronze, ckpt = f"{scratch}/bronze_tx", f"{scratch}/ckpt_a"
    q = start_ingest(spark, tx, bronze, vocab.TRANSACTIONS_SCHEMA, ckpt, AS_OF)
    q.awaitTermination()
    n = spark.read.parquet(bronze).count()
    run_silver_stream(spark, bronze, TRANSACTIONS, f"{scratch}/silver", f"{scratch}/sckpt_a", AS_OF)
    version = latest_version(spark, f"{scratch}/silver")

    def without_last_commit(src, dst):
        local_src, local_dst = src[len("file:"):], dst[len("file:"):]
        last = max(int(f) for f in os.listdir(f"{local_src}/commits") if f.isdigit())
        shutil.copytree(local_src, local_dst, ignore=lambda d, names: (
            [str(last), f".{last}.crc"] if d.endswith("/commits") else []))

    without_last_commit(ckpt, f"{scratch}/ckpt_b")
    q = start_ingest(spark, tx, bronze, vocab.TRANSACTIONS_SCHEMA, f"{scratch}/ckpt_b", AS_OF)
    q.awaitTermination()
    assert q.exception() is None
    assert spark.read.parquet(bronze).count() == n

    without_last_commit(f"{scratch}/sckpt_a", f"{scratch}/sckpt_b")
    run_silver_stream(spark, bronze, TRANSACTIONS, f"{scratch}/silver", f"{scratch}/sckpt_b", AS_OF)
    assert latest_version(spark, f"{scratch}/silver") == version
    batch = silver(read_bronze(spark, bronze), TRANSACTIONS, AS_OF)
    cols = list(TRANSACTIONS.silver_columns)
    assert rows(read_silver(spark, f"{scratch}/silver"), cols) == rows(batch, cols)
