"""Time literals and trailing-range predicates.

``as_of`` replaces the original's ``NOW()``: a fixed instant makes a nightly run
repeatable and lets Catalyst fold ``as_of - INTERVAL`` into one literal that is
pushed into the parquet scan. ``None`` means "now" (live runs).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import as_col

AsOf = "str | _dt.datetime | _dt.date | Column | None"


def ts_literal(value) -> Column:
    """Timestamp literal read in the session time zone (never the Python process zone)."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp")


def now_text(spark) -> str:
    """The session's clock as text in the session time zone (never the Python process zone)."""
    return spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")).first()[0]


def date_literal(value) -> Column:
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.date()
    return F.lit(str(value)).cast("date")


def cutoff(as_of, lookback: str) -> Column:
    """``as_of - INTERVAL lookback`` (constant-folded when ``as_of`` is a literal)."""
    return ts_literal(as_of) - F.expr(f"INTERVAL {lookback}")


def since(time_col: Column | str, as_of, lookback: str | None) -> Column:
    """Lower-bound-only trailing filter ``time_col >= as_of - lookback``.

    ``lookback=None`` keeps everything (the all-history variants).
    """
    if lookback is None:
        return F.lit(True)
    return as_col(time_col) >= cutoff(as_of, lookback)
