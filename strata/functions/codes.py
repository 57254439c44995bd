"""Small code maps and priorities, as CASE expressions over fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata import vocab


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup(c: Column, pairs, default) -> Column:
    expr = None
    for value, code in pairs:
        expr = (F.when(c == value, F.lit(code)) if expr is None
                else expr.when(c == value, F.lit(code)))
    return expr.otherwise(F.lit(default))


def present(c) -> Column:
    """Not null and not blank."""
    c = _col(c)
    return c.isNotNull() & (F.trim(c) != "")


def status_priority(c="status") -> Column:
    """Dedup priority of a raw transaction status: aprobado 3, pendiente 2, else 1.

    Case-sensitive on the raw value, so 'APROBADO' and NULL rank 1.
    """
    return _lookup(_col(c), vocab.STATUS_PRIORITIES, 1)


def doc_priority(c="document_id") -> Column:
    """Users: a row with a document beats one without."""
    return F.when(_col(c).isNotNull(), F.lit(2)).otherwise(F.lit(1))


def name_priority(c="merchant_name") -> Column:
    """Merchants: a row with a non-blank name beats one without."""
    return F.when(present(c), F.lit(2)).otherwise(F.lit(1))


def channel_id(c="channel") -> Column:
    """web 1, app 2, pos 3, anything else 99."""
    return _lookup(_col(c), vocab.CHANNEL_IDS, vocab.OTHER_CHANNEL_ID)


def risk_score(c="risk_level") -> Column:
    """bajo 1, medio 2, alto 3 (case-insensitive), anything else or NULL 0."""
    return _lookup(F.lower(_col(c)), vocab.RISK_SCORES, vocab.UNKNOWN_RISK_SCORE)
