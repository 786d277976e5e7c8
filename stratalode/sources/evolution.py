"""Days of one table whose columns changed over time, read as one table.

Each day's columns are declared in a note beside the data, ``<root>/_schemas/<day>.json``.
The writer removes it before it replaces the day and leaves a new one when it is done, so
a note never speaks of other files than those there. Reading takes the columns from the
notes, so no data file is opened to learn them, and brings each day to the widest type a
column ever had.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalode.functions.folders import remove_folder
from stratalode.functions.names import DATE_PARTITIONS, column, lookup, require_unique
from stratalode.functions.values import relational
from stratalode.sources.dated import ExecutionDate, as_date, day_folders, day_is_complete

# Whole numbers from narrow to wide, with the digits each can hold.
WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
NOTES = "_schemas"


def note_schema(spark: SparkSession, root: str, execution_date: ExecutionDate, schema: T.StructType) -> None:
    """Declare the columns of a day; an earlier note of the day is replaced."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{NOTES}/{as_date(execution_date)}.json")
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = system.create(target, True)
    stream.write(bytearray(schema.json(), "utf-8"))
    stream.close()


def forget_schemas(spark: SparkSession, root: str, execution_date: ExecutionDate = None) -> None:
    """Remove the note of a day, or all notes of a table."""
    remove_folder(spark, f"{root.rstrip('/')}/{NOTES}" + (f"/{as_date(execution_date)}.json" if execution_date else ""))


def noted_schemas(spark: SparkSession, root: str) -> dict[datetime.date, T.StructType]:
    """The declared columns by day. The notes are read by one Spark job, one row per day."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{NOTES}")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return {}
    notes = spark.read.text(f"{root.rstrip('/')}/{NOTES}/*.json", wholetext=True)
    day = F.to_date(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1))
    texts = notes.groupBy("value").agg(F.collect_list(day).alias("days")).collect()
    return {d: T.StructType.fromJson(json.loads(row["value"])) for row in texts for d in row["days"]}


def widest_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that takes the values of both.

    Whole numbers widen to the longer one, numbers with decimals as far as 38 digits go,
    otherwise numbers widen to double, as whole numbers do next to float or double (those
    above 2^53 lose their last digits there, which Spark's own unions accept as well).
    Dates widen to timestamps. Structs, arrays and maps widen inside, by field name.
    Whatever else differs becomes text: numbers and times as Spark casts them, structs,
    arrays and maps as JSON.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return widest_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, widest_type(a.valueType, b.valueType))
    names = [a.simpleString(), b.simpleString()]
    if all(n in WHOLE_DIGITS for n in names):
        return max((a, b), key=lambda t: WHOLE_DIGITS[t.simpleString()])
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _common_decimal(a, b) or T.DoubleType()
    if {T.DateType, T.TimestampType} == {type(a), type(b)}:
        return T.TimestampType()
    return T.StringType()


def _common_decimal(a: T.DataType, b: T.DataType) -> T.DecimalType | None:
    """The decimal for two numbers without a floating point; None beyond 38 digits."""
    shapes = []
    for t in (a, b):
        if isinstance(t, T.DecimalType):
            shapes.append((t.precision - t.scale, t.scale))
        elif t.simpleString() in WHOLE_DIGITS:
            shapes.append((WHOLE_DIGITS[t.simpleString()], 0))
        else:
            return None
    before, after = (max(parts) for parts in zip(*shapes, strict=True))
    return T.DecimalType(before + after, after) if before + after <= 38 else None


def widest_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """All fields of the schemas, each of its widest type, in the order they first appear.

    Names that differ only in case are one field, called as it first appears.
    """
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        require_unique(schema.names, "a day's schema")
        for field in schema.fields:
            known = fields.get(field.name.lower())
            dtype = field.dataType if known is None else widest_type(known.dataType, field.dataType)
            fields[field.name.lower()] = T.StructField(known.name if known else field.name, dtype)
    return T.StructType(list(fields.values()))


def widened(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """``value`` of the type ``old`` as ``new``, a type that :func:`widest_type` gave for it.

    NULL structs, arrays and maps stay NULL; fields that ``old`` lacks are NULL.
    """
    if old == new:
        return value
    if isinstance(new, T.StructType):
        sources = {f.name: lookup(old.names, f.name) for f in new.fields}
        fields = [
            (F.lit(None).cast(f.dataType) if sources[f.name] is None
             else widened(value.getField(sources[f.name]), old[sources[f.name]].dataType, f.dataType)).alias(f.name)
            for f in new.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(new, T.ArrayType):
        return F.transform(value, lambda item: widened(item, old.elementType, new.elementType))
    if isinstance(new, T.MapType):
        return F.transform_values(value, lambda _, item: widened(item, old.valueType, new.valueType))
    if isinstance(old, (T.StructType, T.ArrayType, T.MapType)):
        return relational(value, old)
    return value.cast(new)


def widen(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A frame with the columns of ``schema``, a result of :func:`widest_schema` with the frame's own.

    Columns that need no change stay as they are, so filters on them reach the scan.
    """
    found = {f.name: lookup(df.columns, f.name) for f in schema.fields}
    return df.select(
        *[
            (F.lit(None).cast(f.dataType) if found[f.name] is None
             else widened(column(found[f.name]), df.schema[found[f.name]].dataType, f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def scan_evolving(
    spark: SparkSession,
    root: str,
    first: ExecutionDate = None,
    last: ExecutionDate = None,
    complete: bool = True,
) -> DataFrame:
    """Read the days of a Parquet table whose columns were added to or changed type.

    Every finished day from ``first`` to ``last`` is read with the columns of its note;
    a day without one has a footer opened. Columns come in the order they first appear,
    oldest day first, each of its widest type in the days read (:func:`widest_type`); where
    a day lacks a column it is NULL. ``year, month, day`` follow and prune folders.

    Days with the same columns are one scan, so the plan grows with the number of
    different schemas and not with the days. A table without any finished day is an error.
    """
    days = sorted(d for d in day_folders(spark, root, first, last) if not complete or day_is_complete(spark, d[1], root))
    if not days:
        raise ValueError(f"no finished day below {root}")
    notes = noted_schemas(spark, root)
    schemas = [notes[day] if day in notes else spark.read.parquet(path).schema for day, path in days]
    whole = widest_schema(schemas)
    clashing = [name for name in whole.names if name.lower() in DATE_PARTITIONS]
    if clashing:
        raise ValueError(f"columns {clashing} clash with the date partitions")
    alike: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, (_, path) in zip(schemas, days, strict=True):
        alike.setdefault(schema.json(), (schema, []))[1].append(path)
    parts = T.StructType([T.StructField(name, T.IntegerType()) for name in DATE_PARTITIONS])
    scans = [
        widen(
            spark.read.schema(T.StructType(schema.fields + parts.fields)).option("basePath", root).parquet(*paths),
            T.StructType(whole.fields + parts.fields),
        )
        for schema, paths in alike.values()
    ]
    return reduce(DataFrame.unionAll, scans)
