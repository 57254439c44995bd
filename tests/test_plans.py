"""Plan shape: what would matter at scale."""

from strata.plans.queries import REGISTRY
from tests.conftest import SF_SMALL

QUERIES = dict(REGISTRY)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_no_cross_products_or_windows_in_any_query(spark):
    for name, fn in QUERIES.items():
        if name.startswith("ingest") or name.startswith("mv_"):
            continue
        p = plan(fn(spark, SF_SMALL))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
            assert bad not in p, (name, bad)


def test_dedup_is_partial_aggregate_with_pushed_null_filter(spark):
    df = QUERIES["silver_transactions"](spark, SF_SMALL)
    text = formatted(df)
    assert "partial_max" in text
    assert "PushedFilters: [IsNotNull(transaction_id)]" in text


def test_fact_aggregates_before_merchant_join(spark):
    p = plan(QUERIES["fact_transactions"](spark, SF_SMALL))
    join_at = p.find("Join")
    agg_at = p.find("HashAggregate")
    assert join_at != -1 and agg_at != -1 and join_at < agg_at  # join is above the aggregate


def test_projection_pruned_at_scan(spark):
    df = QUERIES["event_log_rollup"](spark, SF_SMALL)
    text = formatted(df)
    assert "ReadSchema: struct<event_type:string>" in text


def test_expectations_deduplicate_each_table_once(spark):
    text = plan(QUERIES["expectation_metrics"](spark, SF_SMALL))
    final = [line for line in text.split("\n") if "Aggregate" in line and "max(struct" in line and "partial_max" not in line]
    assert len(final) == 3, text


def test_dashboards_read_published_tables(spark):
    for name in ("records_by_layer_table", "records_over_time", "total_rejected", "rejected_details"):
        text = plan(QUERIES[name](spark, SF_SMALL))
        assert "max(struct" not in text and "Join" not in text, name


def test_load_dates_make_the_date_filter_count(spark):
    whole, some = (QUERIES[n](spark, SF_SMALL) for n in ("records_by_layer_table", "records_date_range"))
    assert some.agg({"total_records": "sum"}).first()[0] < whole.agg({"total_records": "sum"}).first()[0]
    assert QUERIES["records_over_time"](spark, SF_SMALL).where("layer = 'Bronze'").count() == 3


def test_daily_windows_keep_rows_without_a_date(spark):
    tx = QUERIES["silver_transactions"](spark, SF_SMALL)
    days = QUERIES["fact_daily_window"](spark, SF_SMALL)
    undated = tx.where("transaction_date is null").count()
    assert undated and days.where("transaction_date is null").agg({"transaction_count": "sum"}).first()[0] == undated
    assert days.agg({"transaction_count": "sum"}).first()[0] == tx.count()


def test_rows_are_told_apart_without_a_broadcast(spark):
    """Winners' ids and orders grow with the input, so neither goes through the driver, however small it seems."""
    from strata.operators.dedup import keep_best, rank_rows
    from strata.operators.entities import TRANSACTIONS
    from strata.sources.testdata import fixture_bronze, raw_frame

    raw = fixture_bronze(spark, SF_SMALL, "transactions")
    for df in (rank_rows(raw, TRANSACTIONS, keep_best(raw, TRANSACTIONS)), raw_frame(spark, SF_SMALL, "transactions")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_shuffles_and_bronze_files_follow_the_input(spark):
    from strata.session import size_shuffles
    from strata.sources.testdata import spread_files

    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        for size in (0, 1 << 30, 6 << 30):
            size_shuffles(spark, size)
            assert int(spark.conf.get(name)) == max(least, size >> 21)
    finally:
        spark.conf.unset(name)
    cores = spark.sparkContext.defaultParallelism
    assert spread_files(spark, 1) == cores and spread_files(spark, cores << 30) is None
