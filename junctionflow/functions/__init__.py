"""Scalar column helpers shared by every operator."""

from .numeric import round_half_up, safe_div
from .text import fixed, hh_mm, hour_label, short_label, thousands
from .timefn import cutoff, date_literal, now_text, since, ts_literal

__all__ = [
    "now_text",
    "cutoff",
    "date_literal",
    "fixed",
    "hh_mm",
    "hour_label",
    "round_half_up",
    "safe_div",
    "short_label",
    "since",
    "thousands",
    "ts_literal",
]
