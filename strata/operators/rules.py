"""Ordered reject rules evaluated once, first match wins.

A rule fires only when its predicate is TRUE; NULL never fires. The rule list is the
single source of both the reject reason and the offending column, so a row is
rejected exactly when ``first_match`` is not NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

REJECT = "_reject"


@dataclass(frozen=True)
class Rule:
    fires: Column
    reason: str
    column: str


def first_match(rules: Sequence[Rule]) -> Column:
    """``struct<reject_reason, error_column>`` of the first rule that is TRUE, else NULL."""
    expr = None
    for rule in rules:
        hit = F.struct(F.lit(rule.reason).alias("reject_reason"),
                       F.lit(rule.column).alias("error_column"))
        expr = F.when(rule.fires, hit) if expr is None else expr.when(rule.fires, hit)
    return expr


def any_fires(rules: Sequence[Rule]) -> Column:
    """TRUE when some rule is TRUE (the OR of all predicates)."""
    out = None
    for rule in rules:
        out = rule.fires if out is None else (out | rule.fires)
    return out
