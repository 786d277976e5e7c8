"""Silver and gold jobs, one by one and as a whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalode import plans, sinks, sources
from stratalode.plans.silver import RAW_SCHEMAS
from workload.fixtures import (
    CARTS,
    CREATED_AT,
    LATER_DATE,
    NEWEST_CARTS,
    PRODUCTS,
    RUN_DATE,
    cart_lines,
    carts,
    exploded,
    flat_products,
    products,
    second_text,
    table,
)
from workload.indicators import SOLD, cents
from workload.registry import oracles, query

DATE_TEXT = "strftime(date, '%Y-%m-%d %H:%M:%S') AS date"
CART_ROWS = f'SELECT id, "userId", {DATE_TEXT}, __v, "products_productId", products_quantity'


def loaded_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart documents with a loader's column, and a placeholder for the unknown closing date."""
    return carts(spark, sf_dir).withColumns(
        {
            "_airbyte_raw_id": F.col("id").cast("string"),
            "closed_on": F.lit("0001-01-01").cast("date"),
        }
    )


def with_date_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date", second_text("date"))


@query(
    f"""
WITH {NEWEST_CARTS}
SELECT id, "userId", {DATE_TEXT}, __v, CAST(NULL AS VARCHAR) AS closed_on,
       coalesce(n, 0) AS products, 'shop' AS channel
FROM newest_carts"""
)
def process_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = plans.process_table(
        loaded_carts(spark, sf_dir), expressions={"channel": "'shop'"}
    )
    return with_date_text(cleaned).withColumns(
        {"products": F.size("products"), "closed_on": F.col("closed_on").cast("string")}
    )


@query(
    f"""
WITH {NEWEST_CARTS}
SELECT id, "userId", {DATE_TEXT}, __v, '0001-01-01' AS closed_on, p1 AS "products_0_productId",
       q1 AS products_0_quantity, p2 AS "products_1_productId", q2 AS products_1_quantity
FROM newest_carts"""
)
def process_and_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = plans.process_and_flatten(loaded_carts(spark, sf_dir))
    return with_date_text(flat).withColumn("closed_on", F.col("closed_on").cast("string"))


@query(f"WITH {PRODUCTS} SELECT * REPLACE (upper(category) AS category) FROM products")
def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.silver_products(
        products(spark, sf_dir), expressions={"category": "upper(category)"}
    )


@query(f"WITH {NEWEST_CARTS} {CART_ROWS} FROM ({exploded('newest_carts')})")
def silver_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_date_text(plans.silver_carts(carts(spark, sf_dir)))


def landed_shop(spark: SparkSession, sf_dir: str) -> str:
    """Raw products and carts of one day in the bronze zone; returns its root."""
    root = sinks.new_folder(spark, "bronze")
    sinks.land_bronze_json(products(spark, sf_dir), root, "products", RUN_DATE)
    sinks.land_bronze_json(carts(spark, sf_dir), root, "carts", RUN_DATE)
    return root


@query("SELECT doc_id, text, lang, source, n_chars, source AS updated_by FROM documents")
def process_table_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole long texts, and a text column that merely sounds like a date."""
    documents = table(spark, sf_dir, "documents").withColumn("updated_by", F.col("source"))
    return plans.process_table(documents, keys="doc_id", not_timestamps="updated_by")


SILVER_PRODUCTS = "SELECT * FROM products"


def both_tables(carts_sql: str, products_sql: str) -> str:
    return f"""
WITH {NEWEST_CARTS}, {PRODUCTS}
SELECT 'carts' AS silver_table, * FROM ({carts_sql})
UNION ALL BY NAME SELECT 'products' AS silver_table, * FROM ({products_sql})"""


def in_one_silver_table(carts: DataFrame, products: DataFrame) -> DataFrame:
    labelled = [
        df.withColumn("silver_table", F.lit(name)) for name, df in (("carts", carts), ("products", products))
    ]
    return labelled[0].unionByName(labelled[1], allowMissingColumns=True)


@query(both_tables(f"{CART_ROWS} FROM ({exploded('newest_carts')})", SILVER_PRODUCTS))
def process_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both shop tables from bronze to silver."""
    bronze, silver = landed_shop(spark, sf_dir), sinks.new_folder(spark, "silver")
    written = plans.process_tables(
        spark, bronze, silver, ["products", "carts"], RUN_DATE, schemas=RAW_SCHEMAS, subdomain="shop"
    )
    return in_one_silver_table(
        with_date_text(sources.scan_parquet(spark, written["carts"])),
        sources.scan_parquet(spark, written["products"]),
    )


@query(both_tables(f"{CART_ROWS} FROM ({exploded('newest_carts')})", SILVER_PRODUCTS))
def process_tables_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into ORC files, run twice for one day: no row is there twice."""
    bronze, silver = landed_shop(spark, sf_dir), sinks.new_folder(spark, "silver")
    for _ in range(2):
        written = plans.process_tables(
            spark, bronze, silver, ["products", "carts"], RUN_DATE,
            schemas=RAW_SCHEMAS, subdomain="shop", target_format="orc",
        )
    carts, products = (
        sources.scan_table(spark, written[name], "orc").drop("year", "month", "day") for name in ("carts", "products")
    )
    return in_one_silver_table(with_date_text(carts), products)


@query(
    f"""
WITH {CARTS}, {PRODUCTS}
SELECT 'carts' AS silver_table, id, "userId", __v, strftime(date, '%Y-%m-%dT%H:%M:%SZ') AS date, coalesce(n, -1) AS n_products,
       CASE WHEN n IS NOT NULL THEN concat_ws(';', p1 || 'x' || q1, p2 || 'x' || q2) END AS products
FROM carts
UNION ALL BY NAME SELECT 'products' AS silver_table, * FROM ({SILVER_PRODUCTS})"""
)
def process_tables_el(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both shop tables copied as they are, rating and products still nested."""
    bronze, silver = landed_shop(spark, sf_dir), sinks.new_folder(spark, "silver")
    written = plans.process_tables(
        spark, bronze, silver, ["products", "carts"], RUN_DATE, mode="EL", schemas=RAW_SCHEMAS
    )
    carts = sources.scan_parquet(spark, written["carts"])
    entries = F.transform("products", lambda p: F.concat_ws("x", p["productId"], p["quantity"]))
    carts = carts.withColumn("n_products", F.coalesce(F.array_size("products"), F.lit(-1)))
    carts = carts.withColumn("products", F.when(F.col("products").isNotNull(), F.array_join(entries, ";")))
    products = sources.scan_parquet(spark, written["products"])
    products = products.withColumns(
        {"rating_count": F.col("rating.count"), "rating_rate": F.col("rating.rate")}
    ).drop("rating")
    return in_one_silver_table(carts, products)


GOLD = ("top10_products_revenue", "sales_daily", "product_performance", "category_performance", "user_ltv")


def in_one_table(frames: dict[str, DataFrame]) -> DataFrame:
    """All gold tables below each other with all their columns."""

    def comparable(name: str) -> DataFrame:
        df = cents(frames[name])
        for column in ("date", "created_at"):
            if column in df.columns:
                df = df.withColumn(column, second_text(column))
        return df.withColumn("gold_table", F.lit(name))

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(comparable, GOLD))


def gold_in_one_table(sold: str = SOLD) -> str:
    """The same in SQL: the indicators' own queries over the lines in ``sold``."""
    return " UNION ALL BY NAME ".join(
        f"SELECT '{name}' AS gold_table, * FROM ({oracles()[name].replace(SOLD, sold)})" for name in GOLD
    )


# The lines of the newest carts under the names that the indicators' SQL uses.
NEWEST_SOLD = f"""
WITH {PRODUCTS}, {NEWEST_CARTS}, newest_lines AS ({exploded("newest_carts")}), sold AS (
    SELECT c.id AS o_orderkey, c."userId" AS o_custkey, c.date AS o_orderdate,
           c.products_quantity AS l_quantity, p.id AS p_partkey, p.title AS p_name,
           p.category AS p_type, p.price AS p_retailprice, p.rating_count AS p_size,
           p.price * c.products_quantity AS revenue
    FROM newest_lines c LEFT JOIN products p ON c."products_productId" = p.id
)"""


@query(gold_in_one_table())
def build_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_one_table(
        plans.build_gold(cart_lines(spark, sf_dir), flat_products(spark, sf_dir), CREATED_AT)
    )


def gold_of(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    return in_one_table({name: sources.scan_parquet(spark, path) for name, path in paths.items()})


@query(gold_in_one_table(NEWEST_SOLD))
def bronze_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole daily run, read back from the gold zone."""
    raw = {"products": products(spark, sf_dir), "carts": carts(spark, sf_dir)}
    paths = plans.run_pipeline(
        spark, raw, sinks.new_folder(spark, "lake"), RUN_DATE, CREATED_AT, subdomain="shop"
    )
    return gold_of(spark, paths)


@query(gold_in_one_table(NEWEST_SOLD))
def bronze_to_gold_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later day with other prices and fewer carts runs first, then the day itself."""
    lake = sinks.new_folder(spark, "lake")
    later = {
        "products": products(spark, sf_dir).withColumn("price", F.col("price") * 20),
        "carts": carts(spark, sf_dir).filter("id % 2 = 0"),
    }
    plans.run_pipeline(spark, later, lake, LATER_DATE, CREATED_AT, subdomain="shop")
    raw = {"products": products(spark, sf_dir), "carts": carts(spark, sf_dir)}
    return gold_of(spark, plans.run_pipeline(spark, raw, lake, RUN_DATE, CREATED_AT, subdomain="shop"))


def changed_in_two_days(spark: SparkSession, sf_dir: str):
    """The carts of two days: on the first some are missing, some wrong and some made up; the second puts it right.

    Yields the lines of new and changed carts and the ids of carts that are gone. All come
    from one copy of the lines, as each would join them again.
    """
    lines = sinks.stage(cart_lines(spark, sf_dir), "cart-lines")
    wrong = lines.where("id % 3 <> 0").withColumns({
        "products_quantity": F.when(F.col("id") % 5 == 0, F.col("products_quantity") + 3).otherwise(F.col("products_quantity")),
        "date": F.when(F.col("id") % 10 == 0, F.lit("1999-12-31").cast("timestamp_ntz")).otherwise(F.col("date")),
        "userId": F.when(F.col("id") % 20 == 0, F.lit(-7)).otherwise(F.col("userId")),
    })
    made_up = lines.where("id % 4 = 0").withColumn("id", -F.col("id"))
    yield wrong.unionByName(made_up), None
    yield lines.where("id % 3 = 0 or id % 5 = 0"), made_up.select("id").distinct()


@query(gold_in_one_table())
def build_gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold from the states of two days with changed and deleted carts; the second day runs twice."""
    states = sinks.new_folder(spark, "gold-states")
    first, second = changed_in_two_days(spark, sf_dir)
    plans.update_gold_states(spark, first[0], states, RUN_DATE)
    for _ in range(2):
        plans.update_gold_states(spark, second[0], states, LATER_DATE, second[1])
    return in_one_table(plans.gold_from_states(spark, states, flat_products(spark, sf_dir), LATER_DATE, CREATED_AT))


@query(gold_in_one_table())
def build_gold_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the states merged after each day."""
    states = sinks.new_folder(spark, "gold-states")
    for day, (lines, gone) in zip((RUN_DATE, LATER_DATE), changed_in_two_days(spark, sf_dir), strict=True):
        plans.update_gold_states(spark, lines, states, day, gone)
        plans.compact_gold_states(spark, states, day)
    return in_one_table(plans.gold_from_states(spark, states, flat_products(spark, sf_dir), LATER_DATE, CREATED_AT))


@query(gold_in_one_table(NEWEST_SOLD))
def bronze_to_gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole daily run on two days: half of the carts and some made-up ones, then the other half without the latter."""
    lake = sinks.new_folder(spark, "lake")
    documents = carts(spark, sf_dir)
    made_up = documents.where("id % 9 = 0").withColumn("id", -F.col("id"))
    raw = {"products": products(spark, sf_dir).withColumn("price", F.col("price") * 2), "carts": documents.where("id % 2 = 0").unionByName(made_up)}
    plans.run_pipeline(spark, raw, lake, RUN_DATE, CREATED_AT, subdomain="shop", incremental=True)
    raw = {"products": products(spark, sf_dir), "carts": documents.where("id % 2 = 1"), "deleted_carts": made_up.select("id").distinct()}
    return gold_of(spark, plans.run_pipeline(spark, raw, lake, LATER_DATE, CREATED_AT, subdomain="shop", incremental=True))
