from tabwarden.sources.load import append_load, csv_to_json, ensure_table, rows_to_json
from tabwarden.sources.probe import probe_columns, probe_tables
from tabwarden.sources.tables import (
    jdbc_options,
    na_to_null,
    read_csv,
    read_jdbc,
    read_table,
    scan_clean,
    write_csv,
    write_jdbc,
    write_report,
)

__all__ = [
    "append_load",
    "csv_to_json",
    "ensure_table",
    "jdbc_options",
    "na_to_null",
    "probe_columns",
    "probe_tables",
    "read_csv",
    "read_jdbc",
    "read_table",
    "rows_to_json",
    "scan_clean",
    "write_csv",
    "write_jdbc",
    "write_report",
]
