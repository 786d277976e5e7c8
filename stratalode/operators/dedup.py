"""Keys, recency and deduplication."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalode.functions.names import as_list, column, lookup, spare_name
from stratalode.functions.values import is_orderable

# Columns that tell the newer of two records, most telling first.
RECENCY_COLUMNS = (
    "_ab_cdc_updated_at",
    "_ab_updated_at",
    "_airbyte_extracted_at",
    "_ab_cdc_cursor",
    "updated_at",
    "updatedAt",
    "__v",
)

# Used when a table has none of the columns above.
FALLBACK_RECENCY_COLUMNS = ("date", "created_at", "createdAt", "timestamp")

# Key columns assumed when none are declared, in this order.
DEFAULT_KEYS = ("id", "_id")


def catalog_keys(catalog: Mapping) -> list[str]:
    """Names a column catalog marks as primary key."""
    return [
        entry["column"]
        for entry in catalog.get("columns_description", [])
        if entry.get("primary_key")
    ]


def resolve_keys(
    df: DataFrame, keys: str | Iterable[str] | None = None, catalog: Mapping | None = None
) -> list[str]:
    """The key columns of a table.

    The first of these whose columns all exist: the ones passed, the catalog's,
    ``id``, ``_id``. Names are matched ignoring case.
    """
    offers = [as_list(keys), catalog_keys(catalog or {}), *([k] for k in DEFAULT_KEYS)]
    for offer in offers:
        found = [lookup(df.columns, name) for name in offer]
        if found and None not in found:
            return found
    raise ValueError(f"no key found among {df.columns}; pass keys or declare them in the catalog")


def recency_columns(
    df: DataFrame, keys: list[str], order_by: str | Iterable[str] | None = None
) -> list[str]:
    """The existing columns that order the versions of a record."""
    for offer in (as_list(order_by) or RECENCY_COLUMNS, FALLBACK_RECENCY_COLUMNS):
        found = [c for c in offer if c in df.columns]
        if found:
            return found
    return keys[:1]


def newest_first(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    tie_break: Iterable[str] | None = None,
) -> list[Column]:
    """Descending sort order over ``order_by`` and then ``tie_break``.

    By default all other columns that can be ordered break ties, so the row kept
    does not depend on how the data was partitioned.
    """
    if tie_break is None:
        tie_break = [f.name for f in df.schema.fields if is_orderable(f.dataType)]
    ordered = dict.fromkeys([*order_by, *tie_break])
    return [column(c).desc() for c in ordered if c not in keys or c in order_by]


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark plans the ``= 1`` filter as a group limit that runs before the shuffle
    as well: every task sends at most one row per key, however often it occurs.
    """
    position = spare_name(df.columns, "_position")
    window = Window.partitionBy(*map(column, keys)).orderBy(*order)
    return (
        df.withColumn(position, F.row_number().over(window))
        .filter(column(position) == 1)
        .drop(position)
    )


def dedup_latest(
    df: DataFrame,
    keys: str | Iterable[str] | None = None,
    order_by: str | Iterable[str] | None = None,
    tie_break: str | Iterable[str] | None = None,
    catalog: Mapping | None = None,
) -> DataFrame:
    """Keep the newest row of every key, NULL recency counting as oldest.

    Ties are broken by all other columns, which therefore are all read.
    ``tie_break=[]`` lets any of the newest rows win.
    """
    keys = resolve_keys(df, keys, catalog)
    order_by = recency_columns(df, keys, order_by)
    tie_break = None if tie_break is None else as_list(tie_break)
    return keep_first(df, keys, newest_first(df, keys, order_by, tie_break))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
