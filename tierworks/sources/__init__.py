from tierworks.sources.catalog import ensure_namespace, list_tables, read_table, resolve
from tierworks.sources.files import (
    Source,
    discover_sources,
    read_csv_source,
    read_json_source,
    read_source,
)
from tierworks.sources.listing import parquet_files
from tierworks.sources.runs import read_runs, run_files

__all__ = [
    "Source",
    "discover_sources",
    "ensure_namespace",
    "list_tables",
    "parquet_files",
    "read_csv_source",
    "read_json_source",
    "read_runs",
    "run_files",
    "read_source",
    "read_table",
    "resolve",
]
