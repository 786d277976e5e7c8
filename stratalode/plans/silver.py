"""Bronze to silver: cleaning one table, the two shop tables, and many tables at once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from stratalode.functions.names import DATE_PARTITIONS
from stratalode.functions.values import holds_arrays
from stratalode.operators.clean import (
    cast_timestamp_columns,
    fill_null_nested,
    limit_string_length,
    nullify_sentinel_dates,
)
from stratalode.operators.columns import drop_ingestion_columns, with_expression, with_expressions
from stratalode.operators.dedup import dedup_latest
from stratalode.operators.nested import explode_unnest, flatten_all, unnest_structs
from stratalode.operators.sizing import size_partitions
from stratalode.plans.parallel import side_by_side
from stratalode.sinks.files import write_silver_parquet
from stratalode.sinks.stage import stage
from stratalode.sinks.tables import table_location, write_table
from stratalode.sources.dated import ExecutionDate, as_date, date_folder, scan_execution_date, table_root

Transform = Callable[[DataFrame], DataFrame]

# Columns of the raw shop tables, in the order JSON inference gives.
RAW_SCHEMAS = {
    "products": (
        "category string, description string, id bigint, image string, price double, "
        "rating struct<count: bigint, rate: double>, title string"
    ),
    "carts": (
        "__v bigint, date string, id bigint, "
        "products array<struct<productId: bigint, quantity: bigint>>, userId bigint"
    ),
}


def process_table(
    df: DataFrame,
    keys: str | Iterable[str] | None = None,
    order_by: str | Iterable[str] | None = None,
    catalog: Mapping | None = None,
    incremental: bool = True,
    expressions: Mapping[str, str] | None = None,
    string_limit: int | None = None,
    timestamps: str | Iterable[str] | None = None,
    not_timestamps: str | Iterable[str] | None = None,
) -> DataFrame:
    """Clean one table.

    In this order: placeholder dates, string length if ``string_limit`` is given,
    newest row per key (only for incremental tables), technical columns,
    timestamps, ``expressions``, NULL arrays and structs. ``timestamps`` restricts
    the columns cast to timestamps and ``not_timestamps`` spares columns that
    merely sound like one, see :func:`cast_timestamp_columns`. Strings become timestamps after the placeholder
    check and are therefore not subject to it.
    """
    df = nullify_sentinel_dates(df)
    if string_limit is not None:
        df = limit_string_length(df, limit=string_limit)
    if incremental:
        df = dedup_latest(df, keys, order_by, catalog=catalog)
    df = drop_ingestion_columns(df)
    df = cast_timestamp_columns(df, timestamps, not_timestamps)
    for name, expression in (expressions or {}).items():
        df = with_expression(df, name, expression)
    return fill_null_nested(df)


def process_and_flatten(
    df: DataFrame,
    keys: str | Iterable[str] | None = None,
    order_by: str | Iterable[str] | None = None,
    catalog: Mapping | None = None,
    incremental: bool = True,
    expressions: Mapping[str, str] | None = None,
    cartesian: bool = False,
    partitions: int = 0,
    staged: bool = True,
    timestamps: str | Iterable[str] | None = None,
    not_timestamps: str | Iterable[str] | None = None,
    max_columns: int | None = None,
) -> DataFrame:
    """Deduplicate, clean and flatten a table down to plain columns, then size its output.

    Turning arrays into columns measures them first. The cleaned rows are written
    to the session's shared folder before that, so that measuring reads single
    columns back instead of deduplicating again; ``staged=False`` prevents it.
    """
    if incremental:
        df = dedup_latest(df, keys, order_by, catalog=catalog)
    df = drop_ingestion_columns(df)
    df = cast_timestamp_columns(df, timestamps, not_timestamps)
    for name, expression in (expressions or {}).items():
        df = with_expression(df, name, expression)
    if staged and not cartesian and any(holds_arrays(f.dataType) for f in df.schema.fields):
        df = stage(df, "cleaned")
    return size_partitions(flatten_all(df, cartesian=cartesian, keyed=incremental, max_columns=max_columns), partitions)


def silver_products(
    df: DataFrame, expressions: Mapping[str, str] | None = None, **options
) -> DataFrame:
    """Cleaned products with the rating spread over two columns."""
    cleaned = with_expressions(process_table(df, **options), expressions or {})
    return fill_null_nested(unnest_structs(cleaned))


def silver_carts(
    df: DataFrame, expressions: Mapping[str, str] | None = None, **options
) -> DataFrame:
    """Cleaned carts, one row per product in the cart; empty carts keep one row."""
    cleaned = with_expressions(process_table(df, **options), expressions or {})
    return fill_null_nested(explode_unnest(cleaned, "products"))


# What each shop table goes through; other tables get `process_table`.
SHOP_CLEANERS = {"products": silver_products, "carts": silver_carts}


def process_tables(
    spark: SparkSession,
    source_root: str,
    target_root: str,
    tables: Iterable[str],
    execution_date: ExecutionDate = None,
    mode: str = "ETL",
    transforms: Mapping[str, Transform] | None = None,
    schemas: Mapping[str, str] | None = None,
    catalogs: Mapping[str, Mapping] | None = None,
    domain: str = "",
    subdomain: str = "",
    source_format: str = "json",
    target_format: str = "parquet",
    write_modes: Mapping[str, str] | None = None,
    concurrency: int = 4,
    options: Mapping[str, Mapping] | None = None,
) -> dict[str, str | None]:
    """Read, clean and write one day of many tables; one Spark job each.

    ``mode="EL"`` copies without cleaning. ``transforms`` replaces what a table
    goes through, ``catalogs`` declares its key, ``schemas`` the columns to read.
    A target is called ``<subdomain>_<table>``. With ``target_format="parquet"``
    each table is a folder of dated snapshots, any other format is a table
    location. Tables whose write mode is not ``append`` are not deduplicated.
    Up to ``concurrency`` tables are worked on at a time. ``options`` holds further
    arguments of :func:`process_table` by table. Appending to a location of files
    replaces the day's own folder, so a rerun adds no row twice.

    Returns the written location per table, None where the day held no rows.
    The first failure is raised.
    """
    if mode not in ("ETL", "EL"):
        raise ValueError(f"mode must be 'ETL' or 'EL', not {mode!r}")
    execution_date = as_date(execution_date)
    transforms, schemas = transforms or {}, schemas or {}
    catalogs, write_modes = catalogs or {}, write_modes or {}

    def process(table: str) -> str | None:
        raw = scan_execution_date(
            spark, source_root, table, execution_date, source_format, schemas.get(table)
        )
        if raw.isEmpty():
            return None
        write_mode = write_modes.get(table, "append")
        if mode == "EL":
            rows = raw.drop(*DATE_PARTITIONS)
        elif table in transforms:
            rows = transforms[table](raw)
        else:
            clean = SHOP_CLEANERS.get(table, process_table)
            rows = clean(
                raw,
                catalog=catalogs.get(table),
                incremental=write_mode == "append",
                **(options or {}).get(table, {}),
            )
        name = f"{subdomain}_{table}" if subdomain else table
        if target_format != "parquet":
            location = table_location(target_root, name, domain, subdomain)
            write_table(
                rows, location, write_mode, target_format, skip_empty=False, execution_date=execution_date
            )
            return location
        write_silver_parquet(rows, target_root, name, execution_date, skip_empty=False)
        return f"{table_root(target_root, name)}/{date_folder(execution_date)}"

    tables = list(tables)
    return dict(zip(tables, side_by_side(spark, process, tables, concurrency), strict=True))
