"""String formatting as column expressions (JVM side, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params
from ._col import as_col
from .numeric import round_half_up


def hour_label(hour: Column | str) -> Column:
    """``7 -> '07:00'``; ``24 -> '24:00'`` (the end label of hour 23)."""
    return F.format_string("%02d:00", as_col(hour))


def thousands(n: Column | str) -> Column:
    """``205377 -> '205,377'``."""
    return F.format_number(as_col(n), 0)


def fixed(x: Column | str, decimals: int) -> Column:
    """``%.Nf`` of a decimal-snapped value, so every engine prints the same digits."""
    return F.format_string(f"%.{decimals}f", round_half_up(x, decimals))


def hh_mm(ts: Column | str) -> Column:
    return F.date_format(as_col(ts), "HH:mm")


def short_label(sensor_id: Column | str, prefix: str = params.LABEL_PREFIX) -> Column:
    """Strip the junction prefix for chart labels."""
    return F.replace(as_col(sensor_id), F.lit(prefix), F.lit(""))
