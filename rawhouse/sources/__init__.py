"""Readers for raw files and writers for tables and files."""

from rawhouse.sources.files import (
    Audited, read_csv_audited, read_csv_strings, read_entity_csvs, read_lines, read_records, read_whole_files,
)
from rawhouse.sources.sinks import ensure_schema, ensure_table, save_table, table_exists, write_csv, write_files

__all__ = [
    "Audited", "read_csv_audited", "read_csv_strings", "read_entity_csvs", "read_lines", "read_records",
    "read_whole_files", "ensure_schema", "ensure_table", "save_table", "table_exists", "write_csv", "write_files",
]
