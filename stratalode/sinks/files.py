"""File sinks. Dated writes replace their own days, so a rerun changes nothing."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalode.functions.names import DATE_PARTITIONS, DELETED_AT, as_list, column
from stratalode.operators.dedup import dedup_latest, resolve_keys
from stratalode.operators.sizing import cluster_rows
from stratalode.operators.upsert import DELETED_ON, live_changes, merge_buckets, merge_dedup, merge_upsert, next_tombstones
from stratalode.sinks.bucketed import scan_bucketed, write_bucketed
from stratalode.sinks.stage import staging
from stratalode.sources.dated import (
    ExecutionDate,
    as_date,
    date_folder,
    day_is_complete,
    latest_partition,
    table_root,
)
from stratalode.sources.evolution import forget_schemas, note_schema

# Fixed value: the records of one compressed JSON file, some 150 MB of text in the shop's tables.
RECORDS_PER_COMPRESSED_FILE = 1_000_000


def _write_dated(
    df: DataFrame,
    root: str,
    fmt: str,
    execution_date: ExecutionDate,
    date_column: str | None,
    options: Mapping[str, str],
    cluster_by: str | Iterable[str] | None = None,
) -> None:
    """Write to one day's folder, or spread rows over days by a date column.

    Spreading first gathers each day in a few tasks, so that not every task
    opens a file in every folder. The rebalance hint cuts days that are too
    large for one task; so do the ranges of ``cluster_by``.
    """
    writer_options = dict(options)
    if date_column is None:
        df = cluster_rows(df, cluster_by) if cluster_by else df
        df.write.mode("overwrite").options(**writer_options).format(fmt).save(
            f"{root}/{date_folder(execution_date)}"
        )
        return
    clashing = [c for c in df.columns if c.lower() in DATE_PARTITIONS and c != date_column]
    if clashing:
        raise ValueError(f"columns {clashing} would be replaced by the parts of {date_column}; rename them")
    day = column(date_column)
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    dated = df.withColumns({name: F.date_format(day, parts[name]) for name in DATE_PARTITIONS})
    if cluster_by:
        dated = cluster_rows(dated, cluster_by, within=DATE_PARTITIONS)
    else:
        dated = dated.hint("rebalance", *DATE_PARTITIONS)
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**writer_options)
        .partitionBy(*DATE_PARTITIONS)
        .format(fmt)
        .save(root)
    )
    # Spark leaves no mark where it moves finished days into place; see `day_is_complete`.
    mark = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{root}/_SUCCESS")
    mark.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).create(mark, True).close()


def land_bronze_json(
    df: DataFrame,
    root: str,
    table: str,
    execution_date: ExecutionDate = None,
    date_column: str | None = None,
    compression: str | None = None,
) -> None:
    """Land raw records as JSON, under the execution date or each record's own day.

    Fields that are NULL are written out, so files without any value in a column
    still carry it. ``compression`` is Spark's name of a codec, such as ``gzip``, which is
    used at its quickest level. As most compressed files are read by one task each, they are
    then cut after a number of records.
    """
    options = {"ignoreNullFields": "false"}
    if compression is not None:
        options |= {
            "compression": compression,
            "zlib.compress.level": "BEST_SPEED",
            "maxRecordsPerFile": str(RECORDS_PER_COMPRESSED_FILE),
        }
    _write_dated(df, table_root(root, table), "json", execution_date, date_column, options)


def write_silver_parquet(
    df: DataFrame,
    root: str,
    table: str,
    execution_date: ExecutionDate = None,
    date_column: str | None = None,
    skip_empty: bool = True,
    cluster_by: str | Iterable[str] | None = None,
    declare: bool = False,
) -> bool:
    """Write a cleaned table as snappy Parquet. Returns whether anything was written.

    ``cluster_by`` writes ranges of these columns, sorted, so that filters on them skip
    files and row groups, see :func:`cluster_rows`. ``declare`` leaves a note of the
    day's columns for :func:`scan_evolving`; it needs an execution date's write, as rows
    spread by ``date_column`` may go to any day. That forgets all notes of the table.

    An empty frame leaves the target alone. That test runs the plan up to its
    first row, which after a shuffle is most of the work: callers that tested
    the input already pass ``skip_empty=False``.
    """
    if skip_empty and df.isEmpty():
        return False
    if declare and date_column is not None:
        raise ValueError("columns are declared for one execution date, not for a date column")
    spark, path = df.sparkSession, table_root(root, table)
    day = as_date(execution_date) if date_column is None else None
    forget_schemas(spark, path, day)
    _write_dated(df, path, "parquet", day, date_column, {"compression": "snappy"}, cluster_by)
    if declare:
        note_schema(spark, path, day, df.schema)
    return True


def write_gold_parquet(
    df: DataFrame,
    path: str,
    partition_cols: str | Iterable[str] | None = None,
    cluster_by: str | Iterable[str] | None = None,
) -> None:
    """Replace a gold table, optionally partitioned, and in sorted ranges of ``cluster_by``."""
    partition_cols = as_list(partition_cols)
    if cluster_by:
        df = cluster_rows(df, cluster_by, within=partition_cols)
    elif partition_cols:
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.mode("overwrite")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)


def merge_snapshot(
    spark: SparkSession,
    incoming: DataFrame,
    root: str,
    table: str,
    execution_date: ExecutionDate,
    keys: str | Iterable[str] | None = None,
    order_by: str | Iterable[str] | None = None,
    existing_is_unique: bool = False,
    how: str = "dedup",
    buckets: int | None = None,
    tombstone_days: int | None = None,
) -> DataFrame:
    """Merge new rows into a table kept as dated snapshots; returns the merged rows.

    The newest snapshot before ``execution_date`` is read and that day's folder
    written. No job overwrites what it reads, a failed run leaves the previous
    snapshot untouched, and a rerun starts from the same state. Columns that tell
    recency stay in the snapshots, so that a change that arrives late is older
    than what it meets.

    ``how="dedup"`` keeps one row per key, see :func:`merge_dedup`; with
    ``existing_is_unique=True`` stored rows are read once and not sorted, which
    holds for snapshots written by merging. ``how="upsert"`` applies a change
    feed, deletions included, see :func:`merge_upsert`; stored keys stay as they are.

    With ``buckets`` the snapshots are kept in that many buckets of the keys, and
    hold each key once: a day then shuffles only what comes in, see
    :func:`merge_buckets`. Keep them to the size of a task, about 1 GB each. The
    first such day after a snapshot without buckets, or with another number, deals
    the stored rows once.

    With ``tombstone_days`` and ``how="upsert"`` the deleted keys of so many days are
    kept beside the snapshots, in ``<table>_tombstones``, so that a change older than
    its key's deletion does not bring it back. This needs a column that tells recency.
    """
    if how not in ("dedup", "upsert"):
        raise ValueError(f"how must be 'dedup' or 'upsert', not {how!r}")
    if tombstone_days is not None and how != "upsert":
        raise ValueError("tombstones are for how='upsert', as how='dedup' deletes nothing")
    path = table_root(root, table)
    earlier = latest_partition(spark, path, execution_date)
    if earlier is None:
        stored = incoming.filter(F.lit(False))
        if how == "upsert":
            stored = stored.drop(*[c for c in incoming.columns if c == DELETED_AT])
    else:
        stored = spark.read.parquet(earlier[1]) if buckets is None else scan_bucketed(spark, earlier[1])
    keys = resolve_keys(stored, keys)
    target = f"{path}/{date_folder(execution_date)}"
    with staging(spark) as keep:
        if tombstone_days is not None:
            folder = f"{table_root(root, table + '_tombstones')}/{date_folder(earlier[0])}" if earlier else ""
            gone = spark.read.parquet(folder) if earlier and day_is_complete(spark, folder) else None
            if gone is not None:
                gone = gone.filter(column(DELETED_ON) > F.lit(as_date(execution_date) - datetime.timedelta(days=tombstone_days)))
            whole = reduce(and_, [column(k).isNotNull() for k in keys])
            newest = dedup_latest(incoming.filter(whole), keys, order_by).unionByName(incoming.filter(~whole))
            incoming = keep(newest if gone is None else live_changes(newest, gone, keys, order_by), "changes")
            left = next_tombstones(stored, incoming, gone, keys, as_date(execution_date), order_by)
            write_silver_parquet(left, root, f"{table}_tombstones", execution_date, skip_empty=False)
        if buckets is not None:
            merged = merge_buckets(stored, incoming, keys, buckets, order_by, how)
            write_bucketed(merged, target, keys, buckets)
            return scan_bucketed(spark, target)
        if how == "upsert":
            merged = merge_upsert(stored, incoming, keys, order_by, keep_recency=True)
        else:
            merged = merge_dedup(stored, incoming, keys, order_by, existing_is_unique=existing_is_unique)
        write_silver_parquet(merged, root, table, execution_date, skip_empty=False)
    return spark.read.schema(merged.schema).parquet(target)
