"""Every registered query equals its independent DuckDB oracle (sf0.001, all keys)."""

import pytest

from __spark_entry__ import entry
from strata.oracle import ORACLE
from strata.plans.queries import REGISTRY as QUERIES
from tests.conftest import SF_MID, SF_SMALL
from tests.helpers import duck, same_as_oracle


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def con_mid():
    return duck(SF_MID)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_small(spark, con_small, name):
    same_as_oracle(QUERIES[name](spark, SF_SMALL), con_small, ORACLE[name])


@pytest.mark.parametrize("name", ["silver_transactions", "quarantine", "fact_transactions",
                                  "rejected_merchants", "reject_reason_counts", "unaccounted"])
def test_core_queries_match_oracle_mid(spark, con_mid, name):
    same_as_oracle(QUERIES[name](spark, SF_MID), con_mid, ORACLE[name])


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["user_id", "merchant_id", "channel_id", "transaction_date", "total_amount",
                          "transaction_count", "reversal_rate", "avg_risk_score", "_ingested_at"]
    assert df.count() > 0


def test_check_values_mid(spark):
    """Counts published with the fixtures (sf0.01)."""
    silver = QUERIES["silver_transactions"](spark, SF_MID)
    assert silver.count() == 34686
    assert silver.filter("transaction_date IS NULL").count() == 650
    assert silver.filter("transaction_type = 'reversa' AND reference_id IS NULL").count() == 546
    assert QUERIES["unaccounted_transactions"](spark, SF_MID).count() == 1265
    assert QUERIES["fact_transactions"](spark, SF_MID).count() == 22172
    counts = {r["reject_reason"]: r["rejected"] for r in
              QUERIES["reject_reason_counts"](spark, SF_MID).filter("source_name = 'transactions'").collect()}
    assert len(counts) == 12  # every transaction rule fires
    by_source = {r["source_name"]: r["n"] for r in QUERIES["reject_reason_counts"](spark, SF_MID)
                 .groupBy("source_name").agg({"reject_reason": "count"}).withColumnRenamed(
                     "count(reject_reason)", "n").collect()}
    assert by_source == {"transactions": 12, "users": 9, "merchants": 9}
