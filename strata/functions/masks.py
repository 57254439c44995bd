"""PII masks and the users row filter, bound to an explicit set of reader groups.

Open-source Spark has no group-membership function, so the reader's groups are an
argument. The masks are plain built-in string expressions; ``register_sql_functions``
also exposes them to SQL as temporary SQL functions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from strata import vocab


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _privileged(groups: Iterable[str]) -> bool:
    return vocab.GROUP_ENGINEERING in set(groups or ())


def mask_full_name(c="full_name", groups: Iterable[str] = ()) -> Column:
    """Engineering sees the name; everyone else a constant (also for NULL)."""
    return _col(c) if _privileged(groups) else F.lit(vocab.MASKED_NAME)


def mask_document_id(c="document_id", groups: Iterable[str] = ()) -> Column:
    """'****' + last 4 characters; NULL stays NULL."""
    c = _col(c)
    return c if _privileged(groups) else F.concat(F.lit(vocab.DOCUMENT_MASK), F.right(c, F.lit(4)))


def mask_email(c="email", groups: Iterable[str] = ()) -> Column:
    """First character + '*****' + the part from '@'.

    Without '@' the whole value follows the mask (substring from position 0), as in the
    original definition.
    """
    c = _col(c)
    if _privileged(groups):
        return c
    return F.concat(F.substring(c, 1, 1), F.lit(vocab.EMAIL_MASK), F.substr(c, F.instr(c, "@")))


def mask_phone(c="phone", groups: Iterable[str] = ()) -> Column:
    """'+' + characters 2-4 + '*******' + last 3 characters."""
    c = _col(c)
    if _privileged(groups):
        return c
    return F.concat(F.lit("+"), F.substring(c, 2, 3), F.lit(vocab.PHONE_MASK), F.right(c, F.lit(3)))


def users_rls(segment="segment", groups: Iterable[str] = ()) -> Column:
    """Row visibility by reader group, first matching group wins.

    ingenieria: all rows; riesgo: premium and estandar; auditoria: premium; else none.
    A NULL segment is visible to ingenieria only.
    """
    groups = set(groups or ())
    seg = _col(segment)
    if vocab.GROUP_ENGINEERING in groups:
        return F.lit(True)
    if vocab.GROUP_RISK in groups:
        return seg.isin(*vocab.RISK_VISIBLE_SEGMENTS)
    if vocab.GROUP_AUDIT in groups:
        return seg.isin(*vocab.AUDIT_VISIBLE_SEGMENTS)
    return F.lit(False)


def register_sql_functions(spark: SparkSession, groups: Iterable[str] = ()) -> None:
    """Register ``mask_*`` and ``users_rls`` as temporary SQL functions for ``groups``."""
    priv = "true" if _privileged(groups) else "false"
    groups = set(groups or ())
    if vocab.GROUP_ENGINEERING in groups:
        rls = "true"
    elif vocab.GROUP_RISK in groups:
        rls = "segment IN (%s)" % ", ".join(f"'{s}'" for s in vocab.RISK_VISIBLE_SEGMENTS)
    elif vocab.GROUP_AUDIT in groups:
        rls = "segment IN (%s)" % ", ".join(f"'{s}'" for s in vocab.AUDIT_VISIBLE_SEGMENTS)
    else:
        rls = "false"
    defs = {
        "mask_full_name": f"CASE WHEN {priv} THEN val ELSE '{vocab.MASKED_NAME}' END",
        "mask_document_id": f"CASE WHEN {priv} THEN val ELSE concat('{vocab.DOCUMENT_MASK}', right(val, 4)) END",
        "mask_email": f"CASE WHEN {priv} THEN val ELSE concat(substring(val, 1, 1), "
                      f"'{vocab.EMAIL_MASK}', substring(val, instr(val, '@'))) END",
        "mask_phone": f"CASE WHEN {priv} THEN val ELSE concat('+', substring(val, 2, 3), "
                      f"'{vocab.PHONE_MASK}', right(val, 3)) END",
    }
    for name, body in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(val STRING) RETURNS STRING RETURN {body}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION users_rls(segment STRING) RETURNS BOOLEAN RETURN {rls}")
