"""Scans of roots laid out as ``<root>/year=YYYY/month=MM/day=DD``."""

from __future__ import annotations

import datetime
import re
from calendar import monthrange
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalode.functions.names import DATE_PARTITIONS
from stratalode.sources.files import Schema, scan_json, scan_parquet

ExecutionDate = str | datetime.date | None


def as_date(value: ExecutionDate) -> datetime.date:
    """An execution date; the default is today in UTC. A time of day is left out."""
    if value is None:
        return datetime.datetime.now(datetime.timezone.utc).date()
    if isinstance(value, datetime.datetime):
        return value.date()
    return datetime.date.fromisoformat(value) if isinstance(value, str) else value


def date_folder(value: ExecutionDate) -> str:
    day = as_date(value)
    return f"year={day.year:04d}/month={day.month:02d}/day={day.day:02d}"


def table_root(root: str, table: str = "") -> str:
    return "/".join(part.rstrip("/") for part in (root, table) if part)


def _folders(spark: SparkSession, parent: str, name: str) -> list[tuple[int, str]]:
    """The folders ``name=<number>`` directly below ``parent``, newest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(parent)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    found = []
    for status in system.listStatus(path):
        label = status.getPath().getName()
        number = label.removeprefix(f"{name}=")
        if status.isDirectory() and label != number and number.isdigit():
            found.append((int(number), f"{parent}/{label}"))
    return sorted(found, reverse=True)


def day_folders(
    spark: SparkSession, root: str, first: ExecutionDate = None, last: ExecutionDate = None
) -> Iterator[tuple[datetime.date, str]]:
    """Days that have a folder, newest first, with its path; ``first`` and ``last`` bound them.

    Only folders are listed, and only those that can hold a day asked for: the
    newest day takes three listings, however many days there are.
    """
    low = as_date(first) if first is not None else datetime.date.min
    high = as_date(last) if last is not None else datetime.date.max
    for year, of_year in _folders(spark, root.rstrip("/"), "year"):
        if not low.year <= year <= high.year:
            continue
        for month, of_month in _folders(spark, of_year, "month"):
            if not (low.year, low.month) <= (year, month) <= (high.year, high.month):
                continue
            for number, path in _folders(spark, of_month, "day"):
                day = _day(year, month, number)
                if day is not None and low <= day <= high:
                    yield day, path


def _day(year: int, month: int, day: int) -> datetime.date | None:
    """The date of a folder; none for stray ones that are no date."""
    try:
        return datetime.date(year, month, day)
    except ValueError:
        return None


def day_is_complete(spark: SparkSession, path: str, root: str | None = None) -> bool:
    """Whether the job that wrote a day's folder has finished.

    A job that writes one day leaves its mark in the folder. One that spreads rows
    over days leaves it in the table's ``root``; files are moved into the days'
    folders at its end, so a day then counts if it has files and no work in progress.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return False
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    if "_SUCCESS" in names:
        return True
    files = [name for name in names if not name.startswith(("_", "."))]
    return root is not None and _exists(spark, f"{root.rstrip('/')}/_SUCCESS") and bool(files) and "_temporary" not in names


def latest_partition(
    spark: SparkSession, root: str, before: ExecutionDate = None, complete: bool = True
) -> tuple[datetime.date, str] | None:
    """The newest finished day and its path, optionally strictly before a day.

    A day that a failed run left half written is passed over, see
    :func:`day_is_complete`; ``complete=False`` takes folders as they are, for days
    written by tools that leave no mark.
    """
    last = None if before is None else as_date(before) - datetime.timedelta(days=1)
    found = day_folders(spark, root, last=last)
    return next((d for d in found if not complete or day_is_complete(spark, d[1], root)), None)


def scan_partitioned_root(
    spark: SparkSession,
    root: str,
    snapshot: str = "all",
    before: ExecutionDate = None,
    schema: Schema | None = None,
    merge_schema: bool = False,
    complete: bool = True,
) -> DataFrame:
    """Read the date partitions of a Parquet table; ``year, month, day`` become columns.

    ``snapshot="all"`` reads every day. ``snapshot="latest"`` reads the newest
    one only, which is what a table written as daily full snapshots needs: it is
    found by listing folders, and no file of another day is opened. A day without
    the mark of a finished job is passed over unless ``complete=False``.
    """
    if snapshot not in ("all", "latest"):
        raise ValueError(f"snapshot must be 'all' or 'latest', not {snapshot!r}")
    if snapshot == "latest":
        newest = latest_partition(spark, root, before, complete)
        if newest is not None:
            return scan_parquet(
                spark, newest[1], schema=schema, base_path=root, merge_schema=merge_schema
            )
    df = scan_parquet(spark, root, schema=schema, merge_schema=merge_schema)
    if snapshot == "latest":
        return df.filter(F.lit(False))
    return df if before is None else df.filter(F.make_date(*DATE_PARTITIONS) < as_date(before))


def scan_execution_date(
    spark: SparkSession,
    root: str,
    table: str = "",
    execution_date: ExecutionDate = None,
    fmt: str = "json",
    schema: Schema | None = None,
) -> DataFrame:
    """Read one day of a table. Only that day's folder is listed.

    Without ``table``, ``root`` may also be a single ``.json`` or ``.parquet`` file
    or a day's own folder. ``<root><table>.<fmt>`` is read if the table has no folder,
    and of a day's own folder, with or without a closing slash, ``<table>.<fmt>`` in it.
    """
    base = table_root(root, table)
    path = f"{base}/{date_folder(execution_date)}"
    day = re.search(r"/year=\d+/month=\d+/day=\d+/?$", root)
    if not table and root.endswith((".json", ".parquet")):
        return _scan(spark, root, root.rpartition(".")[2], schema)
    if not table and day is not None:
        base, path = root[: day.start()], root.rstrip("/")
    elif table and day is not None and _exists(spark, f"{root.rstrip('/')}/{table}.{fmt}"):
        return _scan(spark, f"{root.rstrip('/')}/{table}.{fmt}", fmt, schema)
    elif table and not _exists(spark, base) and _exists(spark, f"{root}{table}.{fmt}"):
        return _scan(spark, f"{root}{table}.{fmt}", fmt, schema)
    if fmt == "json":
        return scan_json(spark, path, schema=schema, base_path=base)
    if fmt == "parquet":
        return scan_parquet(spark, path, schema=schema, base_path=base)
    raise ValueError(f"format must be 'json' or 'parquet', not {fmt!r}")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _scan(spark: SparkSession, path: str, fmt: str, schema: Schema | None) -> DataFrame:
    return {"parquet": scan_parquet, "json": scan_json}[fmt](spark, path, schema=schema)


def date_range_predicate(last: ExecutionDate, current: ExecutionDate, exact: bool = False) -> str:
    """A partition predicate covering the days from ``last`` to ``current``.

    It constrains the outermost partition column that differs, and is therefore
    wider than the range unless both days share a month. ``exact=True`` keeps
    exactly the range. Either way only partition columns are used, so Spark
    drops the other folders before reading.
    """
    first, final = as_date(last), as_date(current)
    if exact:
        return f"make_date(year, month, day) BETWEEN DATE'{first}' AND DATE'{final}'"
    terms = []
    for name in DATE_PARTITIONS:
        low, high = getattr(first, name), getattr(final, name)
        if low != high:
            terms.append(f"{name} BETWEEN {low} AND {high}")
            break
        terms.append(f"{name} = {low}")
    return " AND ".join(terms)


def scan_date_range(
    spark: SparkSession,
    root: str,
    last: ExecutionDate,
    current: ExecutionDate,
    exact: bool = False,
    fmt: str = "parquet",
    schema: Schema | None = None,
) -> DataFrame:
    """Read the partitions from ``last`` to ``current``; see :func:`date_range_predicate`.

    Only folders of these days are given to the reader, so files of other days
    are neither listed nor opened.
    """
    scan = {"parquet": scan_parquet, "json": scan_json}[fmt]
    first, final = as_date(last), as_date(current)
    if not exact and first.year != final.year:
        first, final = first.replace(month=1, day=1), final.replace(month=12, day=31)
    elif not exact and first.month != final.month:
        first, final = first.replace(day=1), final.replace(day=monthrange(final.year, final.month)[1])
    paths = [path for _, path in day_folders(spark, root, first, final)]
    predicate = date_range_predicate(last, current, exact)
    if not paths:  # the columns come from any day there is
        newest = latest_partition(spark, root, complete=False)
        paths, predicate = [newest[1] if newest else root], "false"
    return scan(spark, paths, predicate=predicate, schema=schema, base_path=root)
