"""Scans: text lines, XML records, stored tables."""

from threadloom.sources.tables import read_table, with_row_id
from threadloom.sources.text import read_lines
from threadloom.sources.xml import (
    accepted,
    head_counts,
    is_rejected,
    rejects,
    scan_rows,
    type_records,
)

__all__ = [
    "accepted",
    "head_counts",
    "is_rejected",
    "read_lines",
    "read_table",
    "rejects",
    "scan_rows",
    "type_records",
    "with_row_id",
]
