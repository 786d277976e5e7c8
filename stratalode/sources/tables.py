"""Tables: catalog or path based formats, and relational databases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from stratalode.operators.clean import filter_predicate
from stratalode.sources.files import path_is_missing


def is_location(target: str) -> bool:
    """Tell a path from a table name."""
    return "/" in target


def scan_table(
    spark: SparkSession, target: str, fmt: str = "parquet", predicate: str = ""
) -> DataFrame:
    """Read a table by name, or by location in any installed format."""
    df = spark.read.format(fmt).load(target) if is_location(target) else spark.table(target)
    return filter_predicate(df, predicate)


def table_exists(spark: SparkSession, target: str, fmt: str = "parquet") -> bool:
    """Whether a table is there. Errors other than its absence are raised."""
    if not is_location(target):
        return spark.catalog.tableExists(target)
    try:
        spark.read.format(fmt).load(target)
    except AnalysisException as error:
        if path_is_missing(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return False
        raise
    return True


def jdbc_read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: Sequence | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; a partition column with bounds makes the read parallel."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs (lower, upper) bounds")
        lower, upper = bounds
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    predicate: str = "",
    partition_column: str | None = None,
    bounds: Sequence | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a relational table; the predicate and the columns used are pushed down.

    Give ``partition_column``, ``bounds`` and ``partitions`` to read large tables
    with parallel range queries. Bounds only place the cuts; no row is left out.
    Driver class and credentials belong in ``properties``.
    """
    options = jdbc_read_options(url, table, partition_column, bounds, partitions, fetch_size)
    reader = spark.read.format("jdbc").options(**options, **(properties or {}))
    return filter_predicate(reader.load(), predicate)
