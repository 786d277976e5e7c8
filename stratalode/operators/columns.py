"""Projections, renames and column hygiene. Nothing here shuffles."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalode.functions.names import (
    CDC_PREFIX,
    DATE_PARTITIONS,
    INGESTION_PREFIX,
    as_list,
    column,
    lookup,
    require_unique,
)


def select_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*columns)


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop by name; names the frame does not have are ignored."""
    return df.drop(*columns)


def drop_ingestion_columns(df: DataFrame) -> DataFrame:
    """Drop the loader's own columns and the date partition columns."""
    return df.drop(
        *[c for c in df.columns if c.startswith(INGESTION_PREFIX) or c in DATE_PARTITIONS]
    )


def drop_cdc_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(CDC_PREFIX)])


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Remove ``prefix`` from the names that start with it.

    Every occurrence in such a name goes, not only the leading one.
    """
    renames = {c: c.replace(prefix, "") for c in df.columns if prefix and c.startswith(prefix)}
    if "" in renames.values():
        raise ValueError(f"stripping {prefix!r} would leave a column without a name")
    require_unique([renames.get(c, c) for c in df.columns], "strip_prefix")
    return df.withColumnsRenamed(renames)


def rename_redundant_tokens(df: DataFrame) -> DataFrame:
    """Keep only the last of each repeated ``_``-separated word in a name.

    ``address_city_address`` becomes ``city_address``. Names are handled left to
    right, and a name whose short form is already taken stays as it is.
    """
    names = list(df.columns)
    for position, name in enumerate(names):
        words_from_the_end = dict.fromkeys(reversed(name.split("_")))
        shorter = "_".join(reversed(words_from_the_end))
        if lookup(names, shorter) is None:
            names[position] = shorter
    return df.toDF(*names) if names != df.columns else df


def with_expression(df: DataFrame, name: str, expression: str = "") -> DataFrame:
    """Add or replace one column by a SQL expression; an empty one changes nothing."""
    return df.withColumn(name, F.expr(expression)) if expression else df


def with_expressions(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Replace the columns that exist by SQL expressions, in the given order.

    A later expression sees the result of an earlier one.
    """
    for name, expression in expressions.items():
        if name in df.columns:
            df = df.withColumn(name, F.expr(expression))
    return df


def pii_columns(catalog: Mapping) -> list[str]:
    """Names a column catalog classifies as personal data."""
    return [
        entry["column"]
        for entry in catalog.get("columns_description", [])
        if entry.get("classification") == "PII"
    ]


def split_pii(
    df: DataFrame, catalog: Mapping, keys: str | Iterable[str]
) -> tuple[DataFrame, DataFrame]:
    """Split a table into ``(public, personal)``; both keep ``keys`` for joining back.

    Both results are narrow projections of ``df``, so each scan reads its own
    columns only.
    """
    keys = as_list(keys)
    personal = [
        found
        for name in pii_columns(catalog)
        if (found := lookup(df.columns, name)) is not None and found not in keys
    ]
    public = [c for c in df.columns if c not in personal]
    return (
        df.select(*map(column, public)),
        df.select(*map(column, [*keys, *personal])),
    )
