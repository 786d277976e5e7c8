"""Adding columns computed by Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from stratalode.functions.names import column, spare_name


def in_share(hashed: Column, share: Column | float) -> Column:
    """Whether a 64-bit hash lies in the given share of all hashes, for thinning out before a sample is cut."""
    limit = share if isinstance(share, Column) else F.lit(share)
    return F.pmod(hashed, F.lit(1 << 30)) < limit * (1 << 30)


_libc = next((c for c in [ctypes.CDLL(None)] if hasattr(c, "malloc_trim")), None)  # glibc only

Make = Callable[[pa.RecordBatch], list]


def give_back() -> None:
    """Return freed memory to the system: workers stay for later tasks of other operators."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


@contextlib.contextmanager
def rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs run inside, the session's setting afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def sparing(docs: DataFrame, results: str, apply: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of ``docs`` after ``apply``, also those that have the name of one of its ``results`` (DDL)."""
    names = {f.name.lower() for f in _parse_datatype_string(results)}
    own = {c: spare_name(docs.columns, f"_own_{c}") for c in docs.columns if c.lower() in names}
    return apply(docs.withColumnsRenamed(own)).select(*[column(own.get(c, c)).alias(c) for c in docs.columns])


def with_arrow_columns(df: DataFrame, make: Make, fields: str) -> DataFrame:
    """``df`` with the columns ``fields`` (DDL) that ``make`` gives for each batch.

    Columns of ``df`` with one of these names, in any case, are replaced.
    """
    added = _parse_datatype_string(fields)
    names = {f.name.lower() for f in added}
    df = df.drop(*[c for c in df.columns if c.lower() in names])
    schema = StructType([*df.schema.fields, *added.fields])
    titles = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *make(batch)], titles)
        give_back()

    return df.mapInArrow(run, schema)
