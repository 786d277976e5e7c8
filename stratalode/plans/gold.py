"""Silver to gold: the five indicators from two passes over the cart lines."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalode.plans.contract import GOLD_TABLES, conform_to_schema, constraint_violations
from stratalode.plans.indicators import (
    CreatedAt,
    daily_totals,
    lifetime_value,
    performance_of_categories,
    performance_of_products,
    rank_products,
    sales_by_cart,
    units_by_product,
)
from stratalode.plans.parallel import side_by_side
from stratalode.sinks.files import write_gold_parquet
from stratalode.sinks.stage import stage
from stratalode.sinks.tables import write_jdbc

log = logging.getLogger(__name__)


def build_gold(
    carts: DataFrame,
    products: DataFrame,
    created_at: CreatedAt = None,
    top: int = 10,
    staged: bool = True,
    stage: Callable[[DataFrame, str], DataFrame] = stage,
    whole_carts: bool = False,
) -> dict[str, DataFrame]:
    """All gold tables in their declared schema.

    The five indicators need two aggregates of the cart lines only, one per
    product and one per cart. These are written once to the session's shared
    folder and the indicators computed from them; the lines are read twice
    instead of five times. ``staged=False`` leaves everything lazy. The copies go
    when the process ends; a job that writes the result can pass the ``stage`` of
    a ``sinks.staging`` block to remove them at its end.

    ``whole_carts=True`` says that all lines of a cart have one user and one date, as
    where each cart comes from one document. The aggregate per cart then has one row
    for each, so that carts need not be shuffled again to be counted per day and user.
    """
    units = units_by_product(carts)
    sales = sales_by_cart(carts, products)
    if staged:
        units, sales = side_by_side(
            carts.sparkSession,
            lambda part: stage(*part),
            [(units, "units_by_product"), (sales, "sales_by_cart")],
        )
    frames = {
        "top10_products_revenue": rank_products(units, products, top),
        "sales_daily": daily_totals(sales, created_at, one_row_per_cart=whole_carts),
        "product_performance": performance_of_products(units, products, created_at),
        "category_performance": performance_of_categories(units, products, created_at),
        "user_ltv": lifetime_value(sales, created_at, one_row_per_cart=whole_carts),
    }
    return {name: conform_to_schema(df, GOLD_TABLES[name].schema) for name, df in frames.items()}


def write_gold_tables(
    frames: Mapping[str, DataFrame],
    root: str,
    jdbc_url: str | None = None,
    jdbc_properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Write gold tables as Parquet and, given a URL, to a database as well.

    What is written breaks no rule silently: findings of the tables' contracts are
    counted from the written files and logged as warnings, see
    :func:`constraint_violations`. The database rows are read back from the Parquet just written, so nothing is
    computed twice and both copies carry the same load time.
    """
    paths = {name: f"{root.rstrip('/')}/{name}" for name in frames}

    def write(name: str) -> None:
        df, path = frames[name], paths[name]
        write_gold_parquet(df, path)
        _report_violations(name, df.sparkSession.read.schema(df.schema).parquet(path))
        if jdbc_url is not None:
            written = df.sparkSession.read.schema(df.schema).parquet(path)
            write_jdbc(written, jdbc_url, name, properties=jdbc_properties)

    side_by_side(next(iter(frames.values())).sparkSession, write, frames)
    return paths


def _report_violations(name: str, written: DataFrame) -> None:
    if name not in GOLD_TABLES:
        return
    found = constraint_violations(written, GOLD_TABLES[name].keys, GOLD_TABLES[name].required)
    for row in found.groupBy("rule", "column_name").agg(F.sum("row_count").alias("n")).collect():
        log.warning("%s: %s rows break %s of %s", name, row["n"], row["rule"], row["column_name"])
