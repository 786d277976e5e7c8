"""Submitting independent Spark jobs from driver threads."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")


def side_by_side(
    spark: SparkSession,
    job: Callable[[Item], Result],
    items: Iterable[Item],
    concurrency: int = 4,
) -> list[Result]:
    """Run ``job`` on every item, some at a time; the first failure is raised.

    The last tasks of one job then leave no executor without work.
    """
    with ThreadPoolExecutor(max(1, concurrency)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(job), items))
