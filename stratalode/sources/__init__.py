"""Readers: JSON and Parquet files, date-partitioned roots, tables, JDBC."""

from stratalode.sources.dated import (
    date_range_predicate,
    latest_partition,
    scan_date_range,
    scan_execution_date,
    scan_partitioned_root,
)
from stratalode.sources.evolution import noted_schemas, scan_evolving, widest_schema
from stratalode.sources.files import (
    scan_json,
    scan_json_string_list,
    scan_parquet,
    source_sort_limit,
)
from stratalode.sources.marks import Mark, pending_days, read_mark, since_mark, write_mark
from stratalode.sources.tables import scan_jdbc, scan_table, table_exists

__all__ = [
    "Mark",
    "date_range_predicate",
    "latest_partition",
    "noted_schemas",
    "pending_days",
    "read_mark",
    "scan_date_range",
    "scan_evolving",
    "scan_execution_date",
    "scan_jdbc",
    "scan_json",
    "scan_json_string_list",
    "scan_parquet",
    "scan_partitioned_root",
    "scan_table",
    "since_mark",
    "source_sort_limit",
    "table_exists",
    "widest_schema",
    "write_mark",
]
