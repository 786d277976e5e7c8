"""Sales indicators over cart lines and products.

``carts`` holds one row per cart line: ``id, userId, date, products_productId,
products_quantity``, optionally ``year`` and ``month``. ``products`` holds ``id,
title, category, price, rating_rate, rating_count``.

Indicators per product or category add up the lines of each product before the
join. At most one row per product and task is shuffled then, so neither a best
seller nor the empty carts, whose product is NULL, can fill one task. Indicators
per day or user need the price on every line; they join first and count carts
by ``count distinct``, which Spark spreads over (group, cart) before the groups
meet. No side is broadcast by hint: Spark does so below its size threshold and
otherwise sorts, splitting hot keys of the line side at run time.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalode.functions.values import rounded_ratio, run_timestamp

CreatedAt = str | datetime.datetime | None


def sales_view(carts: DataFrame, products: DataFrame) -> DataFrame:
    """Cart lines with their product and revenue; unknown products leave NULLs."""
    lines = carts.select(
        F.col("id").alias("cart_id"),
        F.col("userId").alias("user_id"),
        "date",
        *[c for c in ("year", "month") if c in carts.columns],
        "products_productId",
        F.col("products_quantity").alias("quantity"),
    )
    catalogue = products.select(
        F.col("id").alias("product_id"),
        F.col("title").alias("product_title"),
        "category",
        "price",
        "rating_rate",
        "rating_count",
    )
    joined = lines.join(
        catalogue, lines["products_productId"] == catalogue["product_id"], "left"
    )
    return joined.select(
        *[c for c in lines.columns if c not in ("products_productId", "quantity")],
        *catalogue.columns,
        "quantity",
        (F.col("price") * F.col("quantity")).alias("revenue"),
    )


def units_by_product(carts: DataFrame) -> DataFrame:
    """Quantity and number of lines per product of the cart lines."""
    return carts.groupBy("products_productId").agg(
        F.sum("products_quantity").alias("quantity"), F.count("*").alias("lines")
    )


def sales_by_cart(carts: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity and revenue per cart, user and date."""
    return (
        sales_view(carts, products)
        .groupBy("cart_id", "user_id", "date")
        .agg(F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue"))
    )


def _sold(units: DataFrame, products: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Units with the named columns of their product."""
    catalogue = products.select("id", *columns)
    return units.join(catalogue, units["products_productId"] == catalogue["id"], how)


def top10_products_revenue(carts: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` products with the highest revenue."""
    return rank_products(units_by_product(carts), products, n)


def rank_products(units: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    return (
        _sold(units, products, ["title", "category", "price"], "inner")
        .groupBy(
            F.col("id").alias("product_id"),
            F.col("title").alias("product_name"),
            "category",
            F.col("price").alias("unit_price"),
        )
        .agg(
            F.sum("quantity").alias("total_units_sold"),
            F.sum(F.col("price") * F.col("quantity")).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(n)
    )


def _carts(one_row_per_cart: bool) -> Column:
    return F.count("cart_id") if one_row_per_cart else F.count_distinct("cart_id")


def _average_ticket(carts: Column) -> Column:
    return rounded_ratio(F.sum("revenue"), carts, 2).alias("avg_ticket")


def sales_daily(
    carts: DataFrame, products: DataFrame, created_at: CreatedAt = None, by_day: bool = False
) -> DataFrame:
    """Revenue, carts, items and average ticket per ``date`` value.

    ``by_day=True`` groups by calendar day where ``date`` has a time of day.
    """
    return daily_totals(sales_view(carts, products), created_at, by_day)


def daily_totals(
    sales: DataFrame, created_at: CreatedAt = None, by_day: bool = False, one_row_per_cart: bool = False
) -> DataFrame:
    """Totals per date. With ``one_row_per_cart`` carts are counted without telling them apart first."""
    carts = _carts(one_row_per_cart)
    date = F.date_trunc("day", "date").alias("date") if by_day else F.col("date")
    return (
        sales.groupBy(date)
        .agg(
            F.sum("revenue").alias("total_revenue"),
            carts.alias("total_orders"),
            F.sum("quantity").alias("total_items"),
            _average_ticket(carts),
        )
        .withColumn("created_at", run_timestamp(created_at))
    )


def product_performance(
    carts: DataFrame, products: DataFrame, created_at: CreatedAt = None
) -> DataFrame:
    """Units, revenue, mean price and rating per product, best revenue first.

    Lines of unknown products form one group with NULL product columns.
    """
    return performance_of_products(units_by_product(carts), products, created_at)


def performance_of_products(
    units: DataFrame, products: DataFrame, created_at: CreatedAt = None
) -> DataFrame:
    sold = _sold(
        units, products, ["title", "category", "price", "rating_rate", "rating_count"], "left"
    )
    priced_lines = F.when(F.col("price").isNotNull(), F.col("lines"))
    mean_price = F.try_divide(F.sum(F.col("price") * F.col("lines")), F.sum(priced_lines))
    return (
        sold.groupBy(
            F.col("id").alias("product_id"), F.col("title").alias("product_title"), "category"
        )
        .agg(
            F.sum("quantity").alias("total_quantity"),
            F.sum(F.col("price") * F.col("quantity")).alias("total_revenue"),
            F.round(mean_price, 2).alias("avg_price"),
            F.max("rating_rate").alias("rating_rate"),
            F.max("rating_count").alias("rating_count"),
        )
        .withColumn("created_at", run_timestamp(created_at))
        .orderBy(F.desc("total_revenue"), "product_id")
    )


def category_performance(
    carts: DataFrame, products: DataFrame, created_at: CreatedAt = None
) -> DataFrame:
    """Revenue, units and share of the total revenue per category.

    The share is a fraction of 1, although its column is called a percentage.
    """
    return performance_of_categories(units_by_product(carts), products, created_at)


def performance_of_categories(
    units: DataFrame, products: DataFrame, created_at: CreatedAt = None
) -> DataFrame:
    sold = _sold(units, products, ["category", "price"], "left")
    base = sold.groupBy("category").agg(
        F.sum(F.col("price") * F.col("quantity")).alias("total_revenue"),
        F.sum("quantity").alias("total_quantity"),
    )
    # The total is a scalar subquery, one row by construction. It asks for both sums
    # although it needs one: with the same columns it reuses the groups' shuffle
    # instead of reading the lines again.
    totals = base.agg(F.struct(F.sum("total_revenue").alias("revenue"), F.sum("total_quantity")))
    share = F.try_divide(F.col("total_revenue"), totals.scalar().getField("revenue"))
    return base.select(
        "category",
        "total_revenue",
        "total_quantity",
        F.round(share, 4).alias("revenue_share_pct"),
        run_timestamp(created_at).alias("created_at"),
    )


def customer_type(orders: Column) -> Column:
    return F.when(orders == 1, "new").when(orders.between(2, 3), "recurrent").otherwise("heavy")


def user_ltv(carts: DataFrame, products: DataFrame, created_at: CreatedAt = None) -> DataFrame:
    """Orders, items, revenue and average ticket per user, and the kind of customer."""
    return lifetime_value(sales_view(carts, products), created_at)


def lifetime_value(
    sales: DataFrame, created_at: CreatedAt = None, one_row_per_cart: bool = False
) -> DataFrame:
    carts = _carts(one_row_per_cart)
    kind = customer_type(F.col("total_orders"))
    return (
        sales.groupBy("user_id")
        .agg(
            carts.alias("total_orders"),
            F.sum("quantity").alias("total_items"),
            F.sum("revenue").alias("total_revenue"),
            _average_ticket(carts),
        )
        .withColumns({"customer_type": kind, "created_at": run_timestamp(created_at)})
    )
