"""Plain file scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalode.functions.names import as_list, column
from stratalode.operators.clean import filter_predicate

Schema = T.StructType | str


def path_is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def scan_json(
    spark: SparkSession,
    path: str | list[str],
    predicate: str = "",
    schema: Schema | None = None,
    multi_line: bool = False,
    base_path: str | None = None,
) -> DataFrame:
    """Read JSON documents, one or an array of them per line.

    Inferring the schema reads the whole input once more; pass ``schema`` for
    large ones. ``multi_line`` is for pretty-printed files.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    return filter_predicate(reader.json(path), predicate)


def scan_parquet(
    spark: SparkSession,
    path: str | list[str],
    predicate: str = "",
    table: str | None = None,
    schema: Schema | None = None,
    merge_schema: bool = True,
    allow_missing: bool = False,
    base_path: str | None = None,
) -> DataFrame:
    """Read Parquet, merging the schemas of all files.

    With ``table``, a file ``<path>/<table>.parquet`` is preferred over the
    folder ``path``. A missing path is an error, or with ``allow_missing`` an
    empty frame of the given ``schema``. Merging reads every footer; a given
    ``schema`` or ``merge_schema=False`` saves that.
    """
    if allow_missing and schema is None:
        raise ValueError("allow_missing needs the schema of the empty frame")
    candidates = [path]
    if table and isinstance(path, str) and not path.endswith(".parquet"):
        candidates.insert(0, f"{path.rstrip('/')}/{table}.parquet")
    for candidate in candidates:
        reader = spark.read.option("mergeSchema", merge_schema and schema is None)
        if schema is not None:
            reader = reader.schema(schema)
        if base_path is not None:
            reader = reader.option("basePath", base_path)
        try:
            return filter_predicate(reader.parquet(*as_list(candidate)), predicate)
        except AnalysisException as error:
            if not path_is_missing(error) or (candidate == candidates[-1] and not allow_missing):
                raise
    return spark.createDataFrame([], schema)


def scan_json_string_list(
    spark: SparkSession, path: str | list[str], name: str, multi_line: bool = False
) -> DataFrame:
    """Read JSON arrays of plain strings into one column, one row per string.

    Each line holds one array. ``multi_line`` takes each file as one array.
    """
    items = F.from_json(column("value"), "array<string>")
    return spark.read.text(path, wholetext=multi_line).select(F.explode(items).alias(name))


def source_sort_limit(
    df: DataFrame, key: str = "id", sort: str = "asc", limit: int | None = None
) -> DataFrame:
    """Order a source by key, ascending or descending, and keep the first ``limit`` rows.

    With a limit Spark keeps the first rows per task and merges those, instead
    of sorting everything.
    """
    if sort not in ("asc", "desc"):
        raise ValueError(f"sort must be 'asc' or 'desc', not {sort!r}")
    order = column(key).asc() if sort == "asc" else column(key).desc()
    ordered = df.orderBy(order)
    return ordered if limit is None else ordered.limit(limit)
