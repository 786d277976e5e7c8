"""High-water marks: how far the days of a table have been worked through.

A mark is a small JSON file that says which days have been processed: all finished
ones up to ``through``, but for those listed as ``missing`` because they had no
finished folder at that time. It is replaced in one step after the work of a run is
done, so a run that fails leaves it as it was and the next one takes the same days
again. A missing day is taken once it is there, however late.
"""

from __future__ import annotations

import contextlib
import datetime
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stratalode.sources.dated import ExecutionDate, as_date, day_folders, day_is_complete
from stratalode.sources.files import Schema, scan_json, scan_parquet


@dataclass(frozen=True)
class Mark:
    """The days processed: those from ``first`` to ``through`` that are not ``missing``."""

    first: datetime.date
    through: datetime.date
    missing: tuple[datetime.date, ...] = ()

    def covers(self, day: datetime.date) -> bool:
        return self.first <= day <= self.through and day not in self.missing


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def read_mark(spark: SparkSession, path: str) -> Mark | None:
    """The mark in a file; None if there is none yet."""
    system, target = _file(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        held = json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()
    days = [datetime.date.fromisoformat(d) for d in (held["first"], held["through"], *held["missing"])]
    return Mark(days[0], days[1], tuple(days[2:]))


def write_mark(spark: SparkSession, path: str, mark: Mark) -> None:
    """Replace a mark: written beside it under another name, then renamed over it."""
    system, target = _file(spark, path)
    spare = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = system.create(spare, False)
    held = {"first": mark.first.isoformat(), "through": mark.through.isoformat(), "missing": [d.isoformat() for d in mark.missing]}
    stream.write(bytearray(json.dumps(held), "utf-8"))
    stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context.rename(system.makeQualified(spare), system.makeQualified(target), options)


@dataclass(frozen=True)
class Pending:
    """What a run has to do: the rows of ``days``, and the mark that stands for them once it is done."""

    rows: DataFrame | None
    days: tuple[datetime.date, ...]
    after: Mark | None


def pending_days(
    spark: SparkSession,
    root: str,
    mark: Mark | None,
    current: ExecutionDate = None,
    first: ExecutionDate = None,
    fmt: str = "parquet",
    schema: Schema | None = None,
) -> Pending:
    """The finished days up to ``current`` that a mark does not cover, with their rows.

    Without a mark the range starts at ``first``, or else at the oldest day there is.
    Days without a finished folder are written down as missing, so none is skipped.
    """
    last = as_date(current)
    start = mark.first if mark else (as_date(first) if first is not None else None)
    found = sorted(day_folders(spark, root, start, last))
    taken = [(day, path) for day, path in found if not (mark and mark.covers(day)) and day_is_complete(spark, path, root)]
    if not taken:
        return Pending(None, (), mark)
    days = tuple(day for day, _ in taken)
    begin = start or days[0]
    through = max(days[-1], mark.through) if mark else days[-1]
    span = (begin + datetime.timedelta(days=n) for n in range((through - begin).days + 1))
    missing = tuple(d for d in span if d not in days and not (mark and mark.covers(d)))
    scan = {"parquet": scan_parquet, "json": scan_json}[fmt]
    rows = scan(spark, [path for _, path in taken], schema=schema, base_path=root)
    return Pending(rows, days, Mark(begin, through, missing))


@contextlib.contextmanager
def since_mark(
    spark: SparkSession,
    root: str,
    path: str,
    current: ExecutionDate = None,
    first: ExecutionDate = None,
    fmt: str = "parquet",
    schema: Schema | None = None,
) -> Iterator[Pending]:
    """`pending_days` since the mark in ``path``, which moves on when the block ends without an error.

    ``with since_mark(spark, root, mark) as todo: ...`` works on ``todo.rows``, which
    is None when nothing is new. The block's own writes should replace what they
    wrote before for the same days, as a run that fails after them comes again.
    """
    before = read_mark(spark, path)
    todo = pending_days(spark, root, before, current, first, fmt, schema)
    yield todo
    if todo.after is not None and todo.after != before:
        write_mark(spark, path, todo.after)
