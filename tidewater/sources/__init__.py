"""Readers: delimited files, the stage folder and the test tables."""

from .delimited import CSV_BULK, CSV_PIPE, bulk_load, project_positional, read_lines, records
from .stage import list_stage, staged_files

__all__ = [
    "CSV_BULK",
    "CSV_PIPE",
    "bulk_load",
    "project_positional",
    "read_lines",
    "records",
    "list_stage",
    "staged_files",
]
