"""Accounting invariants of the pipeline (sf0.01, where every rule fires)."""

import pytest
from pyspark.sql import functions as F

from strata.operators.dedup import keep_best, rank_rows
from strata.operators.entities import DUP, ENTITIES
from strata.plans.medallion import build
from strata.plans.queries import AS_OF
from strata.sources.testdata import fixture_bronzes
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def layers(spark):
    return build(fixture_bronzes(spark, SF_MID), AS_OF)


@pytest.mark.parametrize("name", ["transactions", "users", "merchants"])
def test_raw_is_winners_plus_duplicates_plus_null_keys(layers, name):
    e = ENTITIES[name]
    raw = layers.bronze[name]
    ranked = rank_rows(raw, e, layers.winners[name])
    n_raw = raw.count()
    parts = {r[DUP]: r["n"] for r in ranked.groupBy(DUP).agg(F.count("*").alias("n")).collect()}
    assert sum(parts.values()) == n_raw
    assert parts.get(False, 0) == raw.filter(F.col(e.key).isNotNull()).select(e.key).distinct().count()
    assert parts.get(None, 0) == raw.filter(F.col(e.key).isNull()).count()


@pytest.mark.parametrize("name", ["transactions", "users", "merchants"])
def test_winners_split_into_valid_rejected_unaccounted(layers, name):
    e = ENTITIES[name]
    winners = layers.winners[name].count()
    silver = layers.silver[name].count()
    rejected_winners = (layers.quarantine.filter(F.col("source_name") == name)
                        .filter(~F.col("reject_reason").isin(f"{e.key} duplicado", f"{e.key} nulo crítico"))
                        .count())
    gap = layers.unaccounted[name].count()
    assert winners == silver + rejected_winners + gap


@pytest.mark.parametrize("name", ["transactions", "users", "merchants"])
def test_silver_one_row_per_key(layers, name):
    e = ENTITIES[name]
    s = layers.silver[name]
    assert s.count() == s.select(e.key).distinct().count()


def test_fact_totals_equal_silver(layers):
    fact = layers.gold["fact_transactions"].agg(F.sum("transaction_count").alias("n"),
                                                F.sum("total_amount").alias("amt")).first()
    silver = layers.silver["transactions"].agg(F.count("*").alias("n"), F.sum("amount").alias("amt")).first()
    assert fact["n"] == silver["n"]
    assert fact["amt"] == silver["amt"]


def test_winner_and_duplicates_share_one_order(layers):
    """keep_best and rank_rows agree: the rows flagged as winners are exactly the winners."""
    e = ENTITIES["transactions"]
    raw = layers.bronze["transactions"]
    ranked = rank_rows(raw, e)  # recomputes its own winners
    flagged = ranked.filter(F.col(DUP) == F.lit(False)).select(*e.columns)
    assert flagged.exceptAll(keep_best(raw, e).select(*e.columns)).count() == 0
