"""Joins, aggregates and the gold indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalode import plans
from workload.fixtures import (
    CREATED_AT,
    cart_lines,
    flat_products,
    second_text,
    table,
)
from workload.registry import query

STAMP = f"'{CREATED_AT}' AS created_at"

# Every line item with its order and part, orders without line items included.
SOLD = """
WITH sold AS (
    SELECT orders.*, lineitem.*, part.*, p_retailprice * l_quantity AS revenue
    FROM orders
    LEFT JOIN lineitem ON l_orderkey = o_orderkey
    LEFT JOIN part ON p_partkey = l_partkey
)"""

# One row per order. Prices have one decimal and quantities are whole, so an order's
# revenue is an exact number of cents.
BASKETS = (
    SOLD
    + """,
baskets AS (
    SELECT o_orderkey, o_custkey, o_orderdate, SUM(l_quantity) AS items, SUM(revenue) AS revenue
    FROM sold GROUP BY ALL
)"""
)

# Totals over baskets. The mean of the cents is rounded half up in whole numbers.
BASKET_TOTALS = """
    round(SUM(revenue), 2) AS total_revenue, COUNT(*) AS total_orders,
    CAST(SUM(items) AS BIGINT) AS total_items,
    (2 * CAST(round(SUM(revenue) * 100) AS BIGINT) + COUNT(*)) // (2 * COUNT(*)) / 100.0::DOUBLE
    AS avg_ticket"""


def cents(df: DataFrame) -> DataFrame:
    """Money rounded to cents: the last digits of a double sum depend on its order."""
    return df.withColumn("total_revenue", F.round("total_revenue", 2))


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", second_text("created_at"))


def _sales_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({"date": second_text("date"), "revenue": F.round("revenue", 2)})


SALES_COLUMNS = """
SELECT o_orderkey AS cart_id, o_custkey AS user_id,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       p_partkey AS product_id, p_name AS product_title, p_type AS category,
       p_retailprice AS price, p_size / 10.0::DOUBLE AS rating_rate,
       CAST(p_size AS BIGINT) AS rating_count, CAST(l_quantity AS BIGINT) AS quantity,
       round(revenue, 2) AS revenue
FROM sold"""


@query(SOLD + SALES_COLUMNS)
def sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = plans.sales_view(cart_lines(spark, sf_dir), flat_products(spark, sf_dir))
    return _sales_columns(view)


@query(
    SOLD.replace("ON p_partkey = l_partkey", "ON p_partkey = l_partkey AND p_type <> 'PROMO'")
    + SALES_COLUMNS
)
def sales_view_dangling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales after the promotional products left the catalogue: their lines stay, without product."""
    offered = flat_products(spark, sf_dir).filter(F.col("category") != "PROMO")
    return _sales_columns(plans.sales_view(cart_lines(spark, sf_dir), offered))


@query(
    SOLD
    + """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       p_retailprice AS unit_price, CAST(SUM(l_quantity) AS BIGINT) AS total_units_sold,
       round(p_retailprice * SUM(l_quantity), 2) AS total_revenue
FROM sold WHERE p_partkey IS NOT NULL
GROUP BY p_partkey, p_name, p_type, p_retailprice
ORDER BY total_revenue DESC, product_id
LIMIT 10"""
)
def top10_products_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(
        plans.top10_products_revenue(cart_lines(spark, sf_dir), flat_products(spark, sf_dir))
    )


@query(
    BASKETS
    + f"""
SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date, {BASKET_TOTALS}, {STAMP}
FROM baskets GROUP BY o_orderdate"""
)
def sales_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = plans.sales_daily(
        cart_lines(spark, sf_dir), flat_products(spark, sf_dir), CREATED_AT
    )
    return stamped(cents(daily)).withColumn("date", second_text("date"))


def event_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a cart of one product, at its time of day."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("userId"),
        F.col("ts").alias("date"),
        F.get_json_object("props", "$.k").cast("bigint").alias("products_productId"),
        F.lit(1).cast("bigint").alias("products_quantity"),
    )


@query(
    f"""
WITH baskets AS (
    SELECT CAST(ts AS DATE) AS day, 1 AS items, p_retailprice AS revenue
    FROM events LEFT JOIN part ON p_partkey = CAST(json_extract(props, '$.k') AS BIGINT)
)
SELECT strftime(day, '%Y-%m-%d %H:%M:%S') AS date, {BASKET_TOTALS}, {STAMP}
FROM baskets GROUP BY day"""
)
def sales_daily_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = plans.sales_daily(
        event_carts(spark, sf_dir), flat_products(spark, sf_dir), CREATED_AT, by_day=True
    )
    return stamped(cents(daily)).withColumn("date", second_text("date"))


PERFORMANCE = (
    SOLD
    + f"""
SELECT p_partkey AS product_id, p_name AS product_title, p_type AS category,
       CAST(SUM(l_quantity) AS BIGINT) AS total_quantity, round(SUM(revenue), 2) AS total_revenue,
       round(AVG(p_retailprice), 2) AS avg_price, MAX(p_size) / 10.0::DOUBLE AS rating_rate,
       CAST(MAX(p_size) AS BIGINT) AS rating_count, {STAMP}
FROM sold GROUP BY p_partkey, p_name, p_type"""
)


@query(PERFORMANCE)
def product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamped(
        cents(
            plans.product_performance(
                cart_lines(spark, sf_dir), flat_products(spark, sf_dir), CREATED_AT
            )
        )
    )


@query(
    SOLD
    + f"""
SELECT p_type AS category, round(SUM(revenue), 2) AS total_revenue,
       CAST(SUM(l_quantity) AS BIGINT) AS total_quantity,
       round(SUM(revenue) / SUM(SUM(revenue)) OVER (), 4) AS revenue_share_pct, {STAMP}
FROM sold GROUP BY p_type"""
)
def category_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamped(
        cents(
            plans.category_performance(
                cart_lines(spark, sf_dir), flat_products(spark, sf_dir), CREATED_AT
            )
        )
    )


@query(
    BASKETS
    + f"""
SELECT o_custkey AS user_id, {BASKET_TOTALS},
       CASE total_orders WHEN 1 THEN 'new' WHEN 2 THEN 'recurrent' WHEN 3 THEN 'recurrent'
                         ELSE 'heavy' END AS customer_type, {STAMP}
FROM baskets GROUP BY o_custkey"""
)
def user_ltv(spark: SparkSession, sf_dir: str) -> DataFrame:
    ltv = plans.user_ltv(cart_lines(spark, sf_dir), flat_products(spark, sf_dir), CREATED_AT)
    return stamped(cents(ltv))
