"""Silver: keep the best row per key, validate it, normalize and type it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.operators.dedup import keep_best
from strata.operators.entities import MERCHANTS, TRANSACTIONS, USERS, Entity


def silver(raw: DataFrame, entity: Entity, as_of=None, winners: DataFrame | None = None) -> DataFrame:
    """Winner per key -> validity filter (on raw values) -> normalized, typed row.

    Validity is tested after dedup on purpose: an invalid winner removes its key even
    if a losing row was valid, as in the original pipeline.
    """
    winners = keep_best(raw, entity) if winners is None else winners
    return entity.normalize(winners.filter(entity.valid()), as_of)


def silver_transactions(raw: DataFrame, as_of=None) -> DataFrame:
    return silver(raw, TRANSACTIONS, as_of)


def silver_users(raw: DataFrame, as_of=None) -> DataFrame:
    return silver(raw, USERS, as_of)


def silver_merchants(raw: DataFrame, as_of=None) -> DataFrame:
    return silver(raw, MERCHANTS, as_of)
