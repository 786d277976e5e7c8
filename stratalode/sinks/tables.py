"""Table formats and relational databases."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalode.functions.names import DATE_PARTITIONS, column, lookup
from stratalode.functions.values import relational
from stratalode.operators.clean import filter_soft_deleted
from stratalode.operators.columns import drop_cdc_columns, drop_ingestion_columns
from stratalode.operators.sizing import TARGET_FILE_BYTES
from stratalode.operators.upsert import merge_dedup
from stratalode.sinks.stage import stage
from stratalode.sources.dated import ExecutionDate, as_date, date_folder
from stratalode.sources.tables import is_location, scan_jdbc, table_exists


FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")


def table_location(root: str, table: str, domain: str = "", subdomain: str = "") -> str:
    """``root/domain/subdomain/table``; a subdomain counts only below a domain."""
    parts = [root.rstrip("/"), domain, subdomain if domain else "", table]
    return "/".join(part for part in parts if part)


def without_technical_columns(df: DataFrame) -> DataFrame:
    """Drop soft-deleted rows first, then the columns that told so."""
    return df.transform(filter_soft_deleted).transform(drop_cdc_columns).transform(
        drop_ingestion_columns
    )


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "append",
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    skip_empty: bool = True,
    execution_date: ExecutionDate = None,
) -> bool:
    """Create, append to or overwrite a table, by name or location.

    Technical columns and soft-deleted rows are left out. An empty frame writes
    nothing, unless ``skip_empty=False`` spares the test. Returns whether the
    table existed before.

    With an ``execution_date``, appending to a location of files replaces that
    day's folder below it and nothing else, so a rerun adds no row twice. So does
    appending to a table of files by name: it is created with the partitions year,
    month and day, and a day's rows replace that day's partition.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    existed = table_exists(df.sparkSession, target, fmt)
    rows = without_technical_columns(df)
    if skip_empty and rows.isEmpty():
        return existed
    writer = rows.write.format(fmt).mode(mode if existed else "overwrite")
    if fmt == "iceberg":
        writer = writer.option("write-target-file-size-bytes", str(TARGET_FILE_BYTES))
    elif fmt == "parquet":
        writer = writer.option("compression", "snappy")
    writer = writer.options(**(options or {}))
    if is_location(target) and execution_date is not None and mode == "append" and fmt in FILE_FORMATS:
        writer.mode("overwrite").save(f"{target.rstrip('/')}/{date_folder(execution_date)}")
    elif is_location(target):
        writer.save(target)
    elif execution_date is not None and mode == "append" and fmt in FILE_FORMATS:
        _replace_day_of_table(rows, target, fmt, execution_date, existed, options or {})
    else:
        writer.saveAsTable(target)
    return existed


def _replace_day_of_table(
    rows: DataFrame, target: str, fmt: str, execution_date: ExecutionDate, existed: bool, options: Mapping[str, str]
) -> None:
    """Write a day's partition of a named table, creating the table where there is none."""
    clashing = [c for c in rows.columns if c.lower() in DATE_PARTITIONS]
    if clashing:
        raise ValueError(f"columns {clashing} would be replaced by the parts of the execution date; rename them")
    day = as_date(execution_date)
    if not existed:
        dated = rows.withColumns({name: F.lit(getattr(day, name)) for name in DATE_PARTITIONS})
        dated.write.format(fmt).options(**options).partitionBy(*DATE_PARTITIONS).saveAsTable(target)
        return
    table = rows.sparkSession.table(target)
    partitions = [c.name for c in rows.sparkSession.catalog.listColumns(target) if c.isPartition]
    if partitions != list(DATE_PARTITIONS):
        raise ValueError(f"{target} is not partitioned by {DATE_PARTITIONS}; append to it without an execution date")
    unknown = [c for c in rows.columns if lookup(table.columns, c) is None]
    if unknown:
        raise ValueError(f"{target} lacks the columns {unknown}")
    found = {c: lookup(rows.columns, c) for c in table.columns if c not in partitions}
    aligned = rows.select(*[(column(s) if s else F.lit(None)).cast(table.schema[c].dataType).alias(c) for c, s in found.items()])
    view = f"day_{uuid.uuid4().hex}"
    aligned.createTempView(view)
    try:  # a partition named in full replaces itself and no other
        parts = ", ".join(f"{name} = {getattr(day, name)}" for name in DATE_PARTITIONS)
        rows.sparkSession.sql(f"INSERT OVERWRITE TABLE {target} PARTITION ({parts}) SELECT * FROM {view}")
    finally:
        rows.sparkSession.catalog.dropTempView(view)


def relational_projection(df: DataFrame) -> DataFrame:
    """Reduce every column to text, integer or double.

    Arrays, structs and maps become JSON text, booleans 0 or 1, dates and
    timestamps ISO text, and any other type text.
    """
    return df.select(
        *[relational(column(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def jdbc_write_options(
    url: str, table: str, batch_size: int, connections: int | None, truncate: bool
) -> dict[str, str]:
    options = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "truncate": str(truncate).lower(),
    }
    if connections is not None:
        options["numPartitions"] = str(connections)
    return options


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    batch_size: int = 10_000,
    connections: int | None = None,
    truncate: bool = True,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write to a relational table from the executors; no row passes the driver.

    Overwriting truncates the table where the database allows it, which keeps
    its declared keys. ``connections`` caps the parallel writers.
    """
    options = jdbc_write_options(url, table, batch_size, connections, truncate)
    rows = relational_projection(without_technical_columns(df))
    rows.write.format("jdbc").mode(mode).options(**options, **(properties or {})).save()


def merge_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    keys: str | Iterable[str],
    order_by: str | Iterable[str] | None = None,
    read_options: Mapping | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Merge rows into a relational table by key; see :func:`merge_dedup`.

    The merged rows are written to the shared folder before the table is
    replaced, so the table is not emptied while it is still being read.
    ``read_options`` are those of :func:`scan_jdbc` that make the read parallel.
    """
    existing = scan_jdbc(
        df.sparkSession, url, table, properties=properties, **(read_options or {})
    )
    incoming = relational_projection(df)
    merged = merge_dedup(existing, incoming, keys, order_by, existing_is_unique=True)
    merged = without_technical_columns(merged)
    write_jdbc(stage(merged, table), url, table, properties=properties)
