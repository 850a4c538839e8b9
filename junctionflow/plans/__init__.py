"""Composed jobs: the nightly batch, the reports and the registered query catalog."""

from .nightly import Nightly, nightly_frames, run_nightly
from .report import (
    deployment_report_lines,
    hourly_csv_rows,
    ordered_lines,
    write_csv,
    write_report_text,
)

__all__ = [
    "Nightly",
    "deployment_report_lines",
    "hourly_csv_rows",
    "nightly_frames",
    "ordered_lines",
    "run_nightly",
    "write_csv",
    "write_report_text",
]
