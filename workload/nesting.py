"""Structs, arrays and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalode import operators as ops
from workload.fixtures import CARTS, PRODUCTS, carts, events, exploded, products, second_text, table
from workload.registry import query


@query(f"WITH {PRODUCTS} SELECT * FROM products")
def unnest_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.unnest_structs(products(spark, sf_dir))


def enveloped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change capture delivers documents: in a struct, with control columns."""
    kind = F.struct(F.col("event_type").alias("name"), F.col("value"))
    return events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("_id"),
        F.struct("event_id", kind.alias("kind"), "user_id", "props").alias("data"),
        F.lit("feed").alias("stream"),
        F.col("ts_micros").alias("_ab_cdc_updated_at"),
        F.when(F.col("event_type") == "error", F.col("ts_micros")).alias("_ab_cdc_deleted_at"),
    )


@query(
    """
SELECT CAST(event_id AS VARCHAR) AS _id, event_id AS data_event_id, event_type AS data_kind_name,
       value AS data_kind_value, user_id AS data_user_id, props AS data_props, 'feed' AS stream,
       epoch_us(ts) AS _ab_cdc_updated_at,
       CASE WHEN event_type = 'error' THEN epoch_us(ts) END AS _ab_cdc_deleted_at
FROM events"""
)
def flatten_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.flatten_structs(enveloped_events(spark, sf_dir))


@query(
    """
SELECT event_id, event_type AS kind_name, value AS kind_value, user_id, props,
       epoch_us(ts) AS _ab_cdc_updated_at,
       CASE WHEN event_type = 'error' THEN epoch_us(ts) END AS _ab_cdc_deleted_at
FROM events"""
)
def unwrap_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.unnest_structs(ops.unwrap_document(enveloped_events(spark, sf_dir)))


@query(
    """
SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS lines
FROM documents"""
)
def explode_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by line."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.split("text", "\n").alias("lines")
    )
    return ops.explode_array(documents, "lines")


@query(
    f"""
WITH {CARTS}
SELECT id, "userId", strftime(date, '%Y-%m-%dT%H:%M:%SZ') AS date, __v, "products_productId",
       products_quantity
FROM ({exploded("carts")})"""
)
def explode_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.explode_unnest(carts(spark, sf_dir), "products")


@query(
    "SELECT vec_id, label, "
    + ", ".join(f"embedding[{i + 1}] AS embedding_{i}" for i in range(64))
    + " FROM embeddings"
)
def arrays_to_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.arrays_to_columns(table(spark, sf_dir, "embeddings"))


def tagged_lines(spark: SparkSession, sf_dir: str, *scalars: str) -> DataFrame:
    """Line items with two small arrays."""
    return table(spark, sf_dir, "lineitem").select(
        *scalars,
        F.array("l_returnflag", "l_linestatus").alias("flags"),
        F.array("l_discount", "l_tax").alias("rates"),
    )


@query(
    """
SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, flags, unnest([l_discount, l_tax]) AS rates
FROM (SELECT *, unnest([l_returnflag, l_linestatus]) AS flags FROM lineitem)"""
)
def arrays_cartesian(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tagged_lines(spark, sf_dir, "l_orderkey", "l_linenumber", "l_partkey")
    return ops.arrays_cartesian(lines)


@query(
    """
WITH f AS (
    SELECT DISTINCT l_orderkey, l_linenumber, unnest([l_returnflag, l_linestatus]) AS flags
    FROM lineitem
), r AS (
    SELECT DISTINCT l_orderkey, l_linenumber, unnest([l_discount, l_tax]) AS rates FROM lineitem
)
SELECT DISTINCT * FROM f FULL JOIN r USING (l_orderkey, l_linenumber)"""
)
def arrays_cartesian_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tagged_lines(spark, sf_dir, "l_orderkey", "l_linenumber")
    return ops.arrays_cartesian(lines, match="values")


@query(
    f"""
WITH {CARTS}
SELECT DISTINCT __v, strftime(date, '%Y-%m-%dT%H:%M:%SZ') AS date, id, "userId",
       p1 AS "products_0_productId", q1 AS products_0_quantity,
       p2 AS "products_1_productId", q2 AS products_1_quantity
FROM carts"""
)
def flatten_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.flatten_all(carts(spark, sf_dir))


@query(
    f"""
WITH {CARTS}
SELECT DISTINCT id, "userId", strftime(date, '%Y-%m-%dT%H:%M:%SZ') AS date, __v,
       "products_productId", products_quantity
FROM ({exploded("carts")})"""
)
def flatten_all_cartesian(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.flatten_all(carts(spark, sf_dir), cartesian=True)


PARSED_PROPS = """
SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events"""


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "props")


@query(PARSED_PROPS)
def parse_json_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = ops.parse_json_column(event_props(spark, sf_dir), "props", "struct<k: bigint>")
    return ops.unnest_structs(parsed)


@query(PARSED_PROPS)
def parse_json_column_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.unnest_structs(ops.parse_json_column(event_props(spark, sf_dir), "props"))


@query(
    f"""
WITH {CARTS}
SELECT id, "userId", strftime(date, '%Y-%m-%d %H:%M:%S') AS date, coalesce(n, 0) AS products,
       CAST(NULL AS BIGINT) AS note_length, CAST(NULL AS VARCHAR) AS note_text
FROM carts"""
)
def fill_null_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carts without products get an empty list, a missing note becomes one without content."""
    noted = carts(spark, sf_dir).withColumns(
        {
            "date": F.to_timestamp("date"),
            "note": F.lit(None).cast("struct<length: bigint, text: string>"),
        }
    )
    filled = ops.fill_null_nested(noted)
    sized = filled.withColumns({"products": F.size("products"), "date": second_text("date")})
    return ops.unnest_structs(sized.drop("__v"))
