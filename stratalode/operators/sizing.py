"""Size estimates and output partitioning."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalode.functions.names import as_list, column, spare_name
from stratalode.functions.values import is_orderable, relational

# The size one output file aims at, and the share of the row text
# that is left once the rows are stored as compressed Parquet.
TARGET_FILE_BYTES = 128 * 1024 * 1024
PARQUET_SHARE = 0.25


def estimate_size(df: DataFrame) -> DataFrame:
    """One row: the characters in the text of all rows, and the files they should fill."""

    def text_length(field: T.StructField):
        text = relational(column(field.name), field.dataType).cast("string")
        return F.coalesce(F.length(text), F.lit(0))

    row = sum((text_length(f) for f in df.schema.fields), F.lit(0))
    characters = F.coalesce(F.sum(row.cast("bigint")), F.lit(0))
    files = F.floor(characters * PARQUET_SHARE / TARGET_FILE_BYTES) + 1
    return df.agg(characters.alias("text_chars"), files.cast("int").alias("partitions"))


def partitions_for(df: DataFrame) -> int:
    """The number of output files :func:`estimate_size` suggests. Reads ``df`` once."""
    return estimate_size(df).first()["partitions"]


def estimate_stored_size(df: DataFrame) -> DataFrame:
    """One row on a stored table: its rows, files and bytes, and the files it should fill.

    ``df`` is a scan of files, filtered by partition columns at most. Rows and sizes
    come from the files' footers and listings; no column is read, where
    :func:`estimate_size` turns every row into text.
    """
    files = df.groupBy("_metadata.file_path").agg(
        F.max("_metadata.file_size").alias("size"), F.count("*").alias("held")
    )
    size = F.coalesce(F.sum("size"), F.lit(0))
    return files.agg(
        F.coalesce(F.sum("held"), F.lit(0)).alias("row_count"),
        F.count("*").alias("files"),
        size.alias("stored_bytes"),
        (F.floor(size / TARGET_FILE_BYTES) + 1).cast("int").alias("partitions"),
    )


def planned_bytes(df: DataFrame) -> int | None:
    """Spark's own estimate of a frame's bytes, without any job; None where it has none.

    Spark multiplies the sides of a join, so no more is taken than what is read in all.
    """
    planned = df._jdf.queryExecution().optimizedPlan()
    leaves = planned.collectLeaves()
    read = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    size = min(read, int(planned.stats().sizeInBytes()))
    return size if size < 1 << 60 else None


def cluster_rows(
    df: DataFrame, by: str | Iterable[str], within: Iterable[str] = (), partitions: int = 0
) -> DataFrame:
    """Rows in ranges of ``by``, sorted inside each, so that readers can skip by its values.

    ``within`` are columns that come before, such as those a writer partitions by. The
    ranges also run over a hash of the row, so rows of one hot value, NULL included,
    spread over as many tasks as they fill.

    Spark samples the rows for the ranges' bounds in a job of its own, which runs what
    ``df`` needs a first time: stage costly frames before. The number of ranges is
    ``partitions``, or else the session's number of shuffle partitions, of which adaptive
    execution puts small ones together by the bytes it shuffled. Where the bytes that Spark
    expects (:func:`planned_bytes`) ask for more ranges, it is theirs: these bytes are
    compressed ones, and what a task sorts are whole rows.
    """
    keys = [*within, *as_list(by)]
    salt = spare_name(df.columns, "salt")
    hashed = [column(f.name) for f in df.schema.fields if is_orderable(f.dataType)]
    if not partitions:
        needed = int((planned_bytes(df) or 0) / PARQUET_SHARE) // TARGET_FILE_BYTES + 1
        partitions = needed if needed > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else 0
    ranges = ([partitions] if partitions else []) + [column(k) for k in keys] + [column(salt)]
    ranged = df.withColumn(salt, F.xxhash64(*hashed)).repartitionByRange(*ranges)
    return ranged.sortWithinPartitions(*map(column, keys)).drop(salt)


def size_partitions(df: DataFrame, partitions: int = 0, estimate: bool = False) -> DataFrame:
    """Bring a frame to a sensible number of output files.

    A given number, or the estimated one with ``estimate=True``, is applied by
    ``repartition``: the shuffle leaves the work before it as parallel as it was,
    where ``coalesce`` would run all of it in that many tasks. By default adaptive
    execution sizes the partitions from the bytes it actually shuffled, which
    costs no second pass over the input and splits overlarge partitions too.
    """
    if estimate and not partitions:
        partitions = partitions_for(df)
    return df.repartition(partitions) if partitions else df.hint("rebalance")
