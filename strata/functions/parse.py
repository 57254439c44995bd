"""ANSI-safe parsing of the all-string landing columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata import vocab

AMOUNT_TYPE = "decimal(18,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_value(c="amount") -> Column:
    """Numeric value of a raw amount, for the positivity test.

    ``try_cast`` to decimal(18,2): '0.50' stays 0.50 (a plain string-vs-int compare
    would truncate it or raise under ANSI), and text such as 'S/ 10.00' is NULL.
    """
    return _col(c).try_cast(AMOUNT_TYPE)


def clean_amount(c="amount") -> Column:
    """The value that is tested, ``amount_value``; only where text has none, its digits and dots.

    Exponents are part of a number: '1e5' is 100000.00 and '5e-1' is 0.50. '$100' has no value as
    it stands and becomes 100.00; NULL if nothing is left that reads as a number.
    """
    return F.coalesce(amount_value(c), F.regexp_replace(_col(c), vocab.AMOUNT_JUNK, "").try_cast(AMOUNT_TYPE))


def parse_date(c, *formats: str) -> Column:
    """First format that parses wins; NULL when none does (never raises)."""
    formats = formats or (vocab.DATE_FORMAT,)
    tries = [F.try_to_date(_col(c), fmt) for fmt in formats]
    return tries[0] if len(tries) == 1 else F.coalesce(*tries)

