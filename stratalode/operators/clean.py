"""Row filters and value cleaning. Each operator is one narrow projection."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalode.functions.names import DELETED_AT, as_list, column
from stratalode.functions.values import empty_of, holds_strings, is_sentinel_date, truncated

# Fixed value: the longest string a cleaned table keeps, in characters.
STRING_LIMIT = 32_000

# Words in a string column's name that mark it as a timestamp.
TIMESTAMP_NAME_PARTS = ("date", "time")


def _rewrite(
    df: DataFrame,
    applies: Callable[[T.StructField], bool],
    expression: Callable[[Column, T.DataType], Column],
) -> DataFrame:
    """Replace the columns ``applies`` picks, in one projection and in place."""
    if not any(applies(f) for f in df.schema.fields):
        return df
    return df.select(
        *[
            expression(column(f.name), f.dataType).alias(f.name) if applies(f) else column(f.name)
            for f in df.schema.fields
        ]
    )


def filter_predicate(df: DataFrame, predicate: str = "") -> DataFrame:
    """Keep the rows a SQL predicate accepts; an empty predicate keeps all."""
    return df.filter(predicate) if predicate else df


def filter_soft_deleted(df: DataFrame, deleted_column: str = DELETED_AT) -> DataFrame:
    """Drop rows marked as deleted; a frame without the marker is returned as it is."""
    if deleted_column not in df.columns:
        return df
    return df.filter(column(deleted_column).isNull())


def nullify_sentinel_dates(df: DataFrame) -> DataFrame:
    """Turn the placeholder dates of year 0 and January of year 1 into NULL."""
    dated = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return _rewrite(
        df,
        lambda f: isinstance(f.dataType, dated),
        lambda value, dtype: F.when(~is_sentinel_date(value, dtype), value),
    )


def cast_timestamp_columns(
    df: DataFrame,
    only: str | Iterable[str] | None = None,
    exclude: str | Iterable[str] | None = None,
) -> DataFrame:
    """Cast timestamps, and strings named like one, to TIMESTAMP.

    A string column qualifies when its name contains ``date`` or ``time`` in any
    case. Text that is no timestamp becomes NULL. ``only`` restricts the columns
    looked at and ``exclude`` spares columns that merely sound like a date.
    """
    only, exclude = as_list(only), as_list(exclude)

    def applies(field: T.StructField) -> bool:
        if field.name in exclude or (only and field.name not in only):
            return False
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return True
        return isinstance(field.dataType, T.StringType) and any(
            part in field.name.lower() for part in TIMESTAMP_NAME_PARTS
        )

    return _rewrite(df, applies, lambda value, _: value.try_cast("timestamp"))


def limit_string_length(
    df: DataFrame, columns: str | Iterable[str] | None = None, limit: int = STRING_LIMIT
) -> DataFrame:
    """Cut every string to ``limit`` characters, also inside arrays and structs."""
    columns = as_list(columns)
    return _rewrite(
        df,
        lambda f: holds_strings(f.dataType) and (not columns or f.name in columns),
        lambda value, dtype: truncated(value, dtype, limit),
    )


def fill_null_nested(df: DataFrame, only: str | Iterable[str] | None = None) -> DataFrame:
    """Replace NULL arrays by empty ones and NULL structs by structs of NULLs.

    Top level only; nested arrays and structs are left alone.
    """
    only = as_list(only)
    return _rewrite(
        df,
        lambda f: isinstance(f.dataType, (T.ArrayType, T.StructType))
        and (not only or f.name in only),
        lambda value, dtype: F.coalesce(value, empty_of(dtype)),
    )
