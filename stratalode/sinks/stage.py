"""Shared intermediate results."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from stratalode.functions.folders import remove_folder

_removed_at_exit: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, the same choice on every master.

    ``spark.checkpoint.dir`` of the session, else the checkpoint folder set on its
    context, else a folder below ``spark.sql.warehouse.dir``. The session itself
    is not changed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no one else uses.

    All paths of an application lie in one folder, which is removed when its
    Python process ends: a lazy result may still read it until then.
    """
    home = f"{shared_folder(spark)}/stratalode-{spark.sparkContext.applicationId}"
    if home not in _removed_at_exit:
        _removed_at_exit.add(home)
        atexit.register(_quietly, spark, home)
    return f"{home}/{purpose}-{uuid.uuid4().hex}"


def _quietly(spark: SparkSession, home: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        target = spark._jvm.org.apache.hadoop.fs.Path(home)
        conf = spark._jvm.org.apache.hadoop.conf.Configuration()
        target.getFileSystem(conf).delete(target, True)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result that several jobs use and read it back.

    Losing executors afterwards costs nothing but a re-read. Unlike a cache the
    copy takes no executor memory, and unlike an RDD checkpoint it is columnar
    and has a known size, so later joins can still choose to broadcast it.
    """
    return _written(df, new_folder(df.sparkSession, purpose))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A ``stage`` whose copies are removed at the end of the block, for jobs that write."""
    paths: list[str] = []

    def stage_here(df: DataFrame, purpose: str) -> DataFrame:
        paths.append(new_folder(spark, purpose))
        return _written(df, paths[-1])

    try:
        yield stage_here
    finally:
        for path in paths:
            remove_folder(spark, path)
