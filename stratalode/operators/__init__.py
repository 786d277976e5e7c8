"""DataFrame operators: columns, cleaning, nesting, deduplication and upserts."""

from stratalode.operators.clean import (
    cast_timestamp_columns,
    fill_null_nested,
    filter_predicate,
    filter_soft_deleted,
    limit_string_length,
    nullify_sentinel_dates,
)
from stratalode.operators.columns import (
    drop_cdc_columns,
    drop_columns,
    drop_ingestion_columns,
    rename_redundant_tokens,
    select_columns,
    split_pii,
    strip_prefix,
    with_expression,
    with_expressions,
)
from stratalode.operators.dedup import dedup_latest, distinct_rows, resolve_keys
from stratalode.operators.nested import (
    array_elements,
    array_lengths,
    arrays_cartesian,
    arrays_to_columns,
    explode_array,
    explode_unnest,
    flatten_all,
    flatten_structs,
    parse_json_column,
    unnest_structs,
    unwrap_document,
)
from stratalode.operators.sizing import cluster_rows, estimate_size, estimate_stored_size, partitions_for, planned_bytes, size_partitions
from stratalode.operators.upsert import (
    align_columns,
    live_changes,
    merge_buckets,
    merge_dedup,
    merge_upsert,
    next_tombstones,
)

__all__ = [
    "align_columns",
    "array_elements",
    "array_lengths",
    "arrays_cartesian",
    "arrays_to_columns",
    "cast_timestamp_columns",
    "cluster_rows",
    "dedup_latest",
    "distinct_rows",
    "drop_cdc_columns",
    "drop_columns",
    "drop_ingestion_columns",
    "estimate_size",
    "estimate_stored_size",
    "explode_array",
    "explode_unnest",
    "fill_null_nested",
    "filter_predicate",
    "filter_soft_deleted",
    "flatten_all",
    "flatten_structs",
    "limit_string_length",
    "merge_dedup",
    "live_changes",
    "merge_buckets",
    "merge_upsert",
    "next_tombstones",
    "nullify_sentinel_dates",
    "parse_json_column",
    "partitions_for",
    "planned_bytes",
    "rename_redundant_tokens",
    "resolve_keys",
    "select_columns",
    "size_partitions",
    "split_pii",
    "strip_prefix",
    "unnest_structs",
    "unwrap_document",
    "with_expression",
    "with_expressions",
]
