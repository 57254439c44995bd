"""A full batch run writes every layer; stored tables equal the lazy plan."""

from pyspark.sql import functions as F

from strata.plans.medallion import SILVER_NAMES, build
from strata.plans.publish import publish
from strata.plans.queries import AS_OF
from strata.sources.testdata import fixture_bronzes
from tests.conftest import SF_SMALL
from tests.helpers import multiset


def rows(df):
    cols = [c for c in df.columns if c not in ("processed_at", "raw_record")]
    return multiset(cols, [tuple(r) for r in df.select(*cols).collect()])


def test_publish_equals_lazy_layers(spark, scratch):
    lazy = build(fixture_bronzes(spark, SF_SMALL), AS_OF)
    stored = publish(build(fixture_bronzes(spark, SF_SMALL), AS_OF), scratch, AS_OF)
    for n, name in SILVER_NAMES.items():
        assert rows(stored[name]) == rows(lazy.silver[n])
    assert rows(stored["quarantine"]) == rows(lazy.quarantine)
    for name, df in lazy.gold.items():
        assert rows(stored[name]) == rows(df)
        assert rows(stored[f"mv_{name}"]) == rows(df)
    from strata.functions.masks import register_sql_functions
    from strata.plans.publish import register_views

    register_views(stored, "lake_")
    register_sql_functions(spark, ("riesgo",))
    n = spark.sql("SELECT count(*) FROM lake_users_silver WHERE users_rls(segment)").first()[0]
    assert n == lazy.silver["users"].filter("segment IN ('premium', 'estandar')").count()
    total = spark.sql("SELECT sum(transaction_count) FROM lake_fact_transactions").first()[0]
    assert total == lazy.silver["transactions"].count()


def test_run_log_records_observed_counts(spark, scratch):
    stored = publish(build(fixture_bronzes(spark, SF_SMALL), AS_OF), scratch, AS_OF, run_id="r1")
    log = {(r.table_name, r.metric): r.value for r in stored["run_log"].filter(F.col("run_id") == "r1").collect()}
    for name in ("transactions_silver", "users_silver", "merchants_silver", "quarantine", "fact_transactions"):
        assert log[(name, "rows")] == stored[name].count()
    tx = stored["transactions_silver"]
    assert log[("transactions_silver", "date_parsed__failed")] == tx.filter("transaction_date IS NULL").count()
    assert log[("users_silver", "valid_email__failed")] == 0


def test_job_from_landing_files(spark, scratch):
    """Manifest -> landing files -> bronze -> every layer; equals the lazy plan on the same rows."""
    from strata import vocab
    from strata.plans.job import run_job
    from strata.sources.testdata import fixture_manifest, write_fixture_landing

    specs = write_fixture_landing(spark, SF_SMALL, f"{scratch}/src")
    schemas = {"transactions": vocab.TRANSACTIONS_SCHEMA, "users": vocab.USERS_SCHEMA,
               "merchants": vocab.MERCHANTS_SCHEMA}
    stored = run_job(spark, specs, f"{scratch}/lake", schemas, AS_OF, run_id="job1")
    lazy = build(fixture_bronzes(spark, SF_SMALL), AS_OF)
    for n, name in SILVER_NAMES.items():
        assert rows(stored[name]) == rows(lazy.silver[n])
    for name in ("fact_transactions", "dim_channel", "dim_date", "dim_user", "dim_merchant"):
        assert rows(stored[name]) == rows(lazy.gold[name])
    q_cols = ["source_name", "reject_reason", "error_column"]
    assert rows(stored["quarantine"].select(*q_cols)) == rows(lazy.quarantine.select(*q_cols))
    # a second run with no new landing file leaves bronze unchanged
    again = run_job(spark, fixture_manifest(f"{scratch}/src"), f"{scratch}/lake", schemas, AS_OF)
    assert again["transactions_silver"].count() == lazy.silver["transactions"].count()


def test_failed_publish_leaves_the_whole_old_set(spark, scratch):
    import pytest

    from strata.plans.publish import owner_tables, remove_versions, versions

    first = publish(build(fixture_bronzes(spark, SF_SMALL), AS_OF), scratch, AS_OF, run_id="a")
    before = {n: rows(df) for n, df in owner_tables(spark, scratch).items()}
    assert set(before) == set(first) - {"run_log"}
    bronze = dict(fixture_bronzes(spark, SF_SMALL))
    bronze["users"] = bronze["users"].withColumn("user_id", F.raise_error(F.lit("lost")).cast("string"))  # fails while it is written
    with pytest.raises(Exception, match="lost"):
        publish(build(bronze, AS_OF), scratch, AS_OF, run_id="b")
    assert versions(spark, scratch) == ["a"]
    assert {n: rows(df) for n, df in owner_tables(spark, scratch).items()} == before
    publish(build(fixture_bronzes(spark, SF_SMALL), AS_OF), scratch, AS_OF, run_id="c")
    assert remove_versions(spark, scratch, keep=1) == ["a"] and versions(spark, scratch) == ["c"]
    assert {n: rows(df) for n, df in owner_tables(spark, scratch).items()} == before


def test_job_with_an_inactive_and_an_extra_source(spark, scratch):
    from dataclasses import replace

    from strata import vocab
    from strata.plans.job import run_job
    from strata.sources.testdata import write_fixture_landing

    specs = write_fixture_landing(spark, SF_SMALL, f"{scratch}/src")
    schemas = {"transactions": vocab.TRANSACTIONS_SCHEMA, "users": vocab.USERS_SCHEMA, "merchants": vocab.MERCHANTS_SCHEMA, "more": vocab.USERS_SCHEMA}
    users = next(s for s in specs if s.source_name == "users")
    extra = replace(users, source_name="more", target_table=users.target_table.rsplit(".", 1)[0] + ".more_users")
    some = [replace(s, active=s.source_name != "merchants") for s in specs] + [extra]
    stored = run_job(spark, some, f"{scratch}/lake", schemas, AS_OF, run_id="one")
    assert stored["merchants_silver"].count() == 0 and stored["fact_transactions"].count() > 0
    whole = run_job(spark, specs, f"{scratch}/lake", schemas, AS_OF, run_id="two")
    again = run_job(spark, some, f"{scratch}/lake", schemas, AS_OF, run_id="three")
    assert rows(again["merchants_silver"]) == rows(whole["merchants_silver"]) != []
