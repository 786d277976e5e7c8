"""Shop tables derived from the driver's tables, whole and without grouping.

A cart document is made from one line item, so its array has at most two
elements and no task ever collects a group of rows. Carts of the flat form are
joins of orders and line items.

The SQL text beside each frame derives the same rows for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CREATED_AT = "2024-06-01 00:00:00"
RUN_DATE = "2024-06-01"
LATER_DATE = "2024-06-02"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def second_text(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as the shop delivers them, with the rating as a struct."""
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("description"),
        F.col("p_partkey").alias("id"),
        F.lit(None).cast("string").alias("image"),
        F.col("p_retailprice").alias("price"),
        F.struct(
            F.col("p_size").cast("bigint").alias("count"), (F.col("p_size") / 10.0).alias("rate")
        ).alias("rating"),
        F.col("p_name").alias("title"),
    )


def flat_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as the silver zone holds them."""
    raw = products(spark, sf_dir)
    return raw.select(
        "id",
        "title",
        "category",
        "price",
        F.col("rating.count").alias("rating_count"),
        F.col("rating.rate").alias("rating_rate"),
    )


PRODUCTS = """
products AS (
    SELECT p_partkey AS id, p_name AS title, p_type AS category, p_brand AS description,
           CAST(NULL AS VARCHAR) AS image, p_retailprice AS price,
           CAST(p_size AS BIGINT) AS rating_count, p_size / 10.0::DOUBLE AS rating_rate
    FROM part
)"""


def cart_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart lines as the silver zone holds them: one per line item, one per empty order.

    This is orders LEFT JOIN line items, taken apart: an inner join, in which a
    hot key can be split on either side, and the orders that have no line.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    same_order = F.col("o_orderkey") == F.col("l_orderkey")
    filled = items.join(orders, same_order)
    empty = orders.join(items.select("l_orderkey").distinct(), same_order, "left_anti")
    both = filled.unionByName(empty, allowMissingColumns=True)
    return both.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("userId"),
        F.col("o_orderdate").alias("date"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.col("l_partkey").alias("products_productId"),
        F.col("l_quantity").cast("bigint").alias("products_quantity"),
    )


CART_LINES = """
cart_lines AS (
    SELECT o_orderkey AS id, o_custkey AS "userId", o_orderdate AS date,
           CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month,
           l_partkey AS "products_productId", CAST(l_quantity AS BIGINT) AS products_quantity
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
)"""


def carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart documents. Returned line items give carts without products.

    Ids repeat where the line items repeat (order, line number); ``__v``, the
    document version, grows with the ship date.
    """

    def entry(product: str, quantity: str):
        return F.struct(
            F.col(product).cast("bigint").alias("productId"),
            F.col(quantity).cast("bigint").alias("quantity"),
        )

    bought, gift = entry("l_partkey", "l_quantity"), entry("l_suppkey", "l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.unix_date(F.to_date("l_shipdate")).cast("bigint").alias("__v"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.when(F.col("l_returnflag") == "R", F.lit(None))
        .when(F.col("l_linestatus") == "F", F.array(bought))
        .otherwise(F.array(bought, gift))
        .alias("products"),
        F.col("l_suppkey").alias("userId"),
    )


# n is the number of products, NULL for carts without a list of products.
CARTS = """
carts AS (
    SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS __v,
           l_shipdate AS date, l_orderkey * 8 + l_linenumber AS id, l_suppkey AS "userId",
           CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS n,
           CASE WHEN n >= 1 THEN l_partkey END AS p1,
           CASE WHEN n >= 1 THEN CAST(l_quantity AS BIGINT) END AS q1,
           CASE WHEN n = 2 THEN l_suppkey END AS p2,
           CASE WHEN n = 2 THEN CAST(l_linenumber AS BIGINT) END AS q2
    FROM lineitem
)"""

# The newest document per cart id; ties go by the documents' other fields.
NEWEST_CARTS = (
    CARTS
    + """,
newest_carts AS (
    SELECT * FROM carts
    QUALIFY row_number() OVER (
        PARTITION BY id
        ORDER BY __v DESC, date DESC, n IS NULL, p1 DESC NULLS LAST, q1 DESC NULLS LAST,
                 n DESC NULLS LAST, p2 DESC NULLS LAST, q2 DESC NULLS LAST, "userId" DESC
    ) = 1
)"""
)


def exploded(source: str) -> str:
    """SQL for one row per product in the carts of ``source``."""
    return f"""
    SELECT id, "userId", date, __v, p1 AS "products_productId", q1 AS products_quantity
    FROM {source}
    UNION ALL
    SELECT id, "userId", date, __v, p2, q2 FROM {source} WHERE n = 2
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their time as a number of microseconds beside the timestamp."""
    return table(spark, sf_dir, "events").withColumns(
        {
            "ts": F.col("ts").cast("timestamp"),
            "ts_micros": F.unix_micros(F.col("ts").cast("timestamp")),
        }
    )
