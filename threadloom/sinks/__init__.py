"""Table sinks."""

from threadloom.sinks.tables import (
    conform,
    export_json,
    missing_required,
    stage_rejects,
    stage_scan,
    stage_table,
    write_rejects,
    write_table,
)

__all__ = [
    "conform",
    "export_json",
    "missing_required",
    "stage_rejects",
    "stage_scan",
    "stage_table",
    "write_rejects",
    "write_table",
]
