"""Scans, sinks and typing (``io``) and the driver-table input roles (``roles``)."""

from .io import (
    coerce,
    inline_table,
    path_exists,
    places,
    read_csv,
    read_source,
    read_table,
    require_columns,
    scratch_path,
    write_csv,
    write_guarded,
    write_metrics,
    write_table,
)

__all__ = [
    "coerce", "inline_table", "path_exists", "places", "read_csv", "read_source", "read_table",
    "require_columns", "scratch_path", "write_csv", "write_guarded", "write_metrics", "write_table",
]
