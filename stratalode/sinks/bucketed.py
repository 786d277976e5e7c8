"""Snapshots kept in buckets of their keys.

A bucketed snapshot is a folder of Parquet files that Spark has dealt into buckets
by the hash of the keys, plus a note of how. Joins on the keys leave such rows where
they are: only what comes in is shuffled, to the buckets it belongs to. The note
stands in for a catalog entry, so that any session can read the folder as it is.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

NOTE = "_buckets"


def _quoted(names: Sequence[str]) -> str:
    return ", ".join("`" + name.replace("`", "``") + "`" for name in names)


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Replace a folder by rows in ``buckets`` buckets of ``keys``, each sorted by them.

    Rows that already are dealt that way, such as those of a merge of a bucketed
    snapshot, are written without a shuffle and in one file per bucket.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite").format("parquet").option("compression", "snappy").option("path", path)
    try:
        writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    finally:  # the table only lends its layout to the writer; its files stay
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    system, note = _file(spark, f"{path}/{NOTE}")
    stream = system.create(note, True)
    stream.write(bytearray(json.dumps({"keys": list(keys), "buckets": buckets}), "utf-8"))
    stream.close()


def bucket_note(spark: SparkSession, path: str) -> dict | None:
    """How the rows of a folder are dealt: its keys and number of buckets; None if they are not."""
    system, note = _file(spark, f"{path}/{NOTE}")
    if not system.exists(note):
        return None
    stream = system.open(note)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def scan_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """Read a folder, in its buckets if it has any."""
    plain = spark.read.parquet(path)
    note = bucket_note(spark, path)
    if note is None:
        return plain
    name = f"bucketed_{uuid.uuid4().hex}"
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({plain._jdf.schema().toDDL()}) USING parquet CLUSTERED BY ({_quoted(note['keys'])}) "
        f"SORTED BY ({_quoted(note['keys'])}) INTO {note['buckets']} BUCKETS LOCATION '{location}'"
    )
    try:
        return spark.table(name)
    finally:  # the frame knows its files and buckets; an external table leaves them
        spark.sql(f"DROP TABLE {name}")
