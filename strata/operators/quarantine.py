"""Quarantine: every rejected raw row with its first reason, column and record.

Accounting: each raw row is a NULL-key row, a duplicate, or its key's winner; a
winner is valid (silver), rejected (quarantine) or neither. The last case exists
because silver keeps rows whose predicate is TRUE and quarantine rows whose rule is
TRUE, so a NULL lands in neither; ``unaccounted`` reports those rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import vocab
from strata.functions.stamps import load_date, load_timestamp
from strata.operators.dedup import keep_best, rank_rows
from strata.operators.entities import DUP, MERCHANTS, TRANSACTIONS, USERS, Entity
from strata.operators.rules import REJECT, any_fires, first_match
from strata.sources.bronze import data_columns

QUARANTINE_COLUMNS = ("source_name", "reject_reason", "error_column", "processed_at", "raw_record")


def with_reject(ranked: DataFrame, entity: Entity) -> DataFrame:
    """Add ``_reject`` = struct(reject_reason, error_column) or NULL, evaluated once."""
    return ranked.withColumn(REJECT, first_match(entity.rules()))


def only_rejected(ranked: DataFrame, entity: Entity) -> DataFrame:
    """Rows some rule rejects, with their ``_reject`` struct.

    Filtering on the plain OR of the predicates (TRUE exactly when ``first_match`` is not
    NULL) lets the reason struct be built for rejected rows only.
    """
    rules = entity.rules()
    return ranked.filter(any_fires(rules)).withColumn(REJECT, first_match(rules))


def rejected(raw: DataFrame, entity: Entity, as_of=None, ranked: DataFrame | None = None) -> DataFrame:
    """Rejected rows of one source in quarantine shape.

    ``raw_record`` is the JSON of every bronze column (audit columns included, NULL
    fields omitted) of the rejected row itself.
    """
    ranked = rank_rows(raw, entity) if ranked is None else ranked
    record = [c for c in data_columns(raw)]
    return (only_rejected(ranked, entity)
            .select(F.lit(entity.name).alias("source_name"),
                    F.col(REJECT).getField("reject_reason").alias("reject_reason"),
                    F.col(REJECT).getField("error_column").alias("error_column"),
                    load_timestamp(as_of).alias("processed_at"),
                    F.to_json(F.struct(*[F.col(c) for c in record])).alias("raw_record")))


def rejected_transactions(raw: DataFrame, as_of=None) -> DataFrame:
    return rejected(raw, TRANSACTIONS, as_of)


def rejected_merchants(raw: DataFrame, as_of=None) -> DataFrame:
    return rejected(raw, MERCHANTS, as_of)


def rejected_users(raw: DataFrame, as_of=None) -> DataFrame:
    return rejected(raw, USERS, as_of)


def quarantine(rejects: Iterable[DataFrame], as_of=None) -> DataFrame:
    """Union of per-source rejects by name, stamped with the load date."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rejects)
    return union.withColumn("_ingested_at", load_date(as_of))


def unaccounted(raw: DataFrame, entity: Entity, winners: DataFrame | None = None) -> DataFrame:
    """Winners that are neither valid nor rejected (they would vanish silently)."""
    winners = keep_best(raw, entity) if winners is None else winners
    flagged = with_reject(winners.withColumn(DUP, F.lit(False)), entity)
    return (flagged.filter(~F.coalesce(entity.valid(), F.lit(False)) & F.col(REJECT).isNull())
                   .select(F.lit(entity.name).alias("source_name"), *entity.columns))


def parse_record(quarantine_df: DataFrame, entity: Entity) -> DataFrame:
    """Flatten ``raw_record`` back into the entity's landing columns."""
    schema = vocab.string_schema(entity.columns)
    rec = F.from_json(F.col("raw_record"), schema)
    return quarantine_df.select("source_name", "reject_reason", "error_column",
                                *[rec.getField(c).alias(c) for c in entity.columns])
