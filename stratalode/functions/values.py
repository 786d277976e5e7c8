"""Type-driven column expressions. Each stays inside JVM code generation."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def holds_strings(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return holds_strings(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(holds_strings(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.StringType)


def holds_arrays(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(holds_arrays(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.ArrayType)


def truncated(value: Column, dtype: T.DataType, limit: int) -> Column:
    """``value`` with every string in it, at any depth, cut to ``limit`` characters.

    NULL arrays and structs stay NULL; maps are left alone. A string of at most
    ``limit`` bytes cannot have more characters, so its characters are not counted.
    """
    if not holds_strings(dtype):
        return value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: truncated(item, dtype.elementType, limit))
    if isinstance(dtype, T.StructType):
        fields = [
            truncated(value.getField(f.name), f.dataType, limit).alias(f.name)
            for f in dtype.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    return F.when(F.octet_length(value) > limit, F.substring(value, 1, limit)).otherwise(value)


def empty_of(dtype: T.ArrayType | T.StructType) -> Column:
    """The empty array, or the struct whose fields are all NULL."""
    if isinstance(dtype, T.ArrayType):
        return F.array().cast(dtype)
    return F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in dtype.fields])


def is_sentinel_date(value: Column, dtype: T.DataType) -> Column:
    """True for dates whose text starts with ``0000-`` or ``0001-01-``.

    Those two prefixes form one unbroken range, so two comparisons replace a
    cast to text and a regular expression on every row.
    """
    first = F.lit("0000-01-01").cast(dtype)
    after_last = F.lit("0001-02-01").cast(dtype)
    return (value >= first) & (value < after_last)


def relational(value: Column, dtype: T.DataType) -> Column:
    """``value`` in one of the four types any relational target accepts."""
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(value)
    if isinstance(dtype, T.BooleanType):
        return value.cast("int")
    if isinstance(dtype, (T.IntegerType, T.LongType, T.DoubleType, T.StringType)):
        return value
    return value.cast("string")


def is_orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return is_orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(is_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def rounded_ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """``round(numerator / denominator, scale)``; NULL when the denominator is 0.

    The numerator passes through decimal(38,6): the trailing noise of a double
    sum, which changes with the order of addition, cannot tip a rounding tie.
    """
    exact = F.try_divide(numerator.try_cast("decimal(38,6)"), denominator.cast("decimal(20,0)"))
    return F.round(exact, scale).cast("double")


def run_timestamp(created_at: str | datetime.datetime | None) -> Column:
    """The load time stamped on gold rows: the given one, else the query's start."""
    if created_at is None:
        return F.current_timestamp()
    return F.lit(created_at).cast("timestamp")
