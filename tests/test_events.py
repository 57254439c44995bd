"""The event log of pipeline runs, and repair of days that a stream has closed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import events as E
from strata.streaming.fact import daily_fact
from strata.streaming.repair import CLOSED, repair_closed_days, read_repaired_fact, run_closed_groups
from tests.helpers import multiset

AS_OF = dt.datetime(2024, 12, 31)


def test_a_failed_run_logs_its_error_and_earlier_runs_stay(spark, scratch):
    assert E.read_events(spark, scratch).count() == 0
    with E.EventLog(spark, scratch, "one", AS_OF) as log:
        log.add("flow_progress", "7 rows", layer="Silver", table="t", metrics={"rows": 7, "ok__passed": 5, "ok__failed": 2})
    with pytest.raises(KeyError):
        with E.EventLog(spark, scratch, "two", AS_OF):
            raise KeyError("gone")
    rows = {r.id: r for r in E.read_events(spark, scratch).collect()}
    assert sorted(rows) == ["one:0", "one:1", "one:2", "two:0", "two:1"]
    assert rows["one:1"].level == "WARN" and rows["one:1"].details.expectations[0].asDict() == {"name": "ok", "passed": 5, "failed": 2}
    assert rows["two:1"].level == "ERROR" and rows["two:1"].error.class_name == "KeyError" and rows["one:2"].error is None
    shown = E.event_dimensions(E.read_events(spark, scratch))
    assert tuple(shown.columns) == E.DIMENSIONS
    assert shown.where("id = 'two:1'").first().sequence == '{"run_id":"two","number":1}'


def test_long_runs_do_not_gather_events_on_the_driver(spark, scratch, monkeypatch):
    monkeypatch.setattr(E, "PENDING", 10)
    log = E.EventLog(spark, scratch, "r", AS_OF)
    most = 0
    for i in range(25):
        log.add("flow_progress", str(i))
        most = max(most, len(log._pending))
    log.flush()
    assert most < 10 and E.read_events(spark, scratch).selectExpr("count(DISTINCT sequence.number)").first()[0] == 25


TX = "transaction_id string, user_id string, merchant_id string, channel string, transaction_type string, amount decimal(18,2), transaction_date date"


def _tx(spark, rows):
    return spark.createDataFrame([(i, u, m, c, t, a, d and dt.date.fromisoformat(d)) for i, u, m, c, t, a, d in rows],
                                 TX.replace("decimal(18,2)", "int")).withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def _rows(df, like):
    return multiset(like.columns, [tuple(r) for r in df.select(*like.columns).collect()])


def test_closed_days_with_corrections_equal_the_batch_fact(spark, scratch):
    merchants = spark.createDataFrame([("m", "alto"), ("n", None)], "merchant_id string, risk_level string")
    drops = [
        [("1", "u", "m", "web", "pago", 10, "2024-01-01"), ("2", "u", "m", "web", "reversa", 5, "2024-01-01"),
         ("3", "v", "n", "pos", "pago", 7, "2024-01-02"), ("4", "v", "n", "pos", "pago", 1, "2024-01-09")],
        [("5", "u", "m", "web", "pago", 3, "2024-01-01"), ("6", "w", "m", "app", "pago", 2, None),
         ("7", None, None, None, None, 2, "2023-12-01"), ("8", "v", "n", "pos", "pago", 4, "2024-01-20")],
        [],
    ]
    schema = _tx(spark, drops[0]).schema
    for k, rows in enumerate(drops):
        spark.createDataFrame(_tx(spark, rows).rdd, schema).write.parquet(f"{scratch}/landing/drop={k}") if rows else None
        stream = spark.readStream.schema(schema).parquet(f"{scratch}/landing/drop=*")
        run_closed_groups(stream, f"{scratch}/{CLOSED}", f"{scratch}/ckpt", "1 day")
        tx = spark.read.parquet(f"{scratch}/landing").drop("drop")
        repair_closed_days(spark, scratch, tx)
        assert not repair_closed_days(spark, scratch, tx)              # nothing is left to repair
        expected = daily_fact(tx, merchants)
        assert _rows(read_repaired_fact(spark, scratch, tx, merchants), expected) == _rows(expected, expected)
    # a winner goes, and another changes in a day of the same size, which is named
    changed = tx.where("transaction_id != '7'").withColumn("amount", F.when(F.col("transaction_id") == "3", F.lit(70)).otherwise(F.col("amount")).cast("decimal(18,2)"))
    assert repair_closed_days(spark, scratch, changed, days=[dt.date(2024, 1, 2)])
    expected = daily_fact(changed, merchants)
    assert _rows(read_repaired_fact(spark, scratch, changed, merchants), expected) == _rows(expected, expected)


def test_repair_without_closed_days_fills_rows_without_a_date(spark, scratch):
    merchants = spark.createDataFrame([], "merchant_id string, risk_level string")
    tx = _tx(spark, [("1", "u", "m", "web", "pago", 10, "2024-01-01"), ("2", "u", "m", "web", "pago", 5, None)])
    assert repair_closed_days(spark, scratch, tx)
    expected = daily_fact(tx, merchants)
    assert _rows(read_repaired_fact(spark, scratch, tx, merchants), expected) == _rows(expected, expected)
    assert not repair_closed_days(spark, scratch, tx)
