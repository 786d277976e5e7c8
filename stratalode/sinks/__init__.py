"""Writers: dated JSON and Parquet, gold tables, table formats, JDBC."""

from stratalode.sinks.bucketed import scan_bucketed, write_bucketed
from stratalode.sinks.files import (
    land_bronze_json,
    merge_snapshot,
    write_gold_parquet,
    write_silver_parquet,
)
from stratalode.sinks.stage import new_folder, remove_folder, stage, staging
from stratalode.sinks.tables import (
    merge_jdbc,
    relational_projection,
    table_location,
    write_jdbc,
    write_table,
)

__all__ = [
    "land_bronze_json",
    "merge_jdbc",
    "merge_snapshot",
    "new_folder",
    "relational_projection",
    "remove_folder",
    "scan_bucketed",
    "stage",
    "staging",
    "table_location",
    "write_bucketed",
    "write_gold_parquet",
    "write_jdbc",
    "write_silver_parquet",
    "write_table",
]
