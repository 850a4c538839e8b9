"""Rounding and arithmetic that behave the same in Spark and in a SQL oracle.

Plain ``round(double, n)`` disagrees across engines in the last digit because
each rounds the binary value differently. Snapping the double to
``DECIMAL(38,10)`` first and rounding the decimal (half up) gives one answer
everywhere; the SQL twin is ``CAST(ROUND(CAST(x AS DECIMAL(38,10)), n) AS DOUBLE)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import as_col

SNAP = "decimal(38,10)"


def round_half_up(col: Column | str, scale: int) -> Column:
    """Decimal-snapped half-up rounding; NULL for NULL, NaN or infinity.

    From 2**53 on a double has no fraction to round and is returned as it is
    (the decimal would overflow from 1e28 on).
    """
    x = as_col(col).cast("double")
    whole = (F.abs(x) >= F.lit(2.0**53)) & (F.abs(x) < F.lit(float("inf")))
    return F.when(whole, x).otherwise(F.round(as_col(col).try_cast(SNAP), scale).cast("double"))


def safe_div(num: Column | str, den: Column | str) -> Column:
    """Division that yields NULL (not an ANSI error, not infinity) on a zero divisor."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))
