"""Load stamps. ``as_of`` pins them for reproducible runs and oracle checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def load_date(as_of: dt.date | dt.datetime | str | None = None) -> Column:
    """``current_date()`` or the fixed date of ``as_of``."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return F.lit(str(as_of)).cast("date")


def load_timestamp(as_of: dt.date | dt.datetime | str | None = None) -> Column:
    """``current_timestamp()`` or the fixed instant of ``as_of`` (midnight for a date)."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(str(as_of)).cast("timestamp")
