"""Columns, filters, value cleaning and output sizing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalode import operators as ops
from stratalode.sources import source_sort_limit as first_of_source
from workload.fixtures import events, second_text, table
from workload.registry import query

CUSTOMER_CATALOG = {
    "columns_description": [
        {"column": "c_custkey", "data_type": "int8", "classification": "NPC", "primary_key": True},
        {"column": "c_name", "data_type": "string", "classification": "PII"},
        {"column": "c_nationkey", "data_type": "int4", "classification": "NPC"},
        {"column": "c_acctbal", "data_type": "double", "classification": "PII"},
        {"column": "c_mktsegment", "data_type": "string", "classification": "NPC"},
    ]
}


def loaded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the technical columns of a loader and of change capture."""
    return events(spark, sf_dir).select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.concat(F.lit("raw-"), F.col("event_id").cast("string")).alias("_airbyte_raw_id"),
        F.col("ts_micros").alias("_airbyte_extracted_at"),
        F.col("ts_micros").alias("_ab_cdc_updated_at"),
        F.when(F.col("event_type") == "error", F.col("ts_micros")).alias("_ab_cdc_deleted_at"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
    )


LOADED_EVENTS = """
WITH loaded AS (
    SELECT event_id, user_id, event_type, value, 'raw-' || event_id AS _airbyte_raw_id,
           epoch_us(ts) AS _airbyte_extracted_at, epoch_us(ts) AS _ab_cdc_updated_at,
           CASE WHEN event_type = 'error' THEN epoch_us(ts) END AS _ab_cdc_deleted_at,
           CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
           CAST(day(ts) AS INTEGER) AS day
    FROM events
)"""


@query("SELECT p_partkey, p_name, p_retailprice FROM part")
def select_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.select_columns(table(spark, sf_dir, "part"), ["p_partkey", "p_name", "p_retailprice"])


@query("SELECT p_partkey, p_name, p_retailprice FROM part")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.drop_columns(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])


@query(
    LOADED_EVENTS
    + """
SELECT event_id, user_id, event_type, value, _ab_cdc_updated_at, _ab_cdc_deleted_at FROM loaded"""
)
def drop_ingestion_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.drop_ingestion_columns(loaded_events(spark, sf_dir))


@query(
    LOADED_EVENTS
    + """
SELECT event_id, user_id, event_type, value, _airbyte_raw_id, _airbyte_extracted_at,
       year, month, day FROM loaded"""
)
def drop_cdc_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.drop_cdc_columns(loaded_events(spark, sf_dir))


@query(
    """
SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment FROM customer"""
)
def strip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.strip_prefix(table(spark, sf_dir, "customer"), "c_")


@query(
    """
SELECT s_suppkey AS supplier_key, s_name AS name, s_nationkey AS nation_key,
       s_acctbal AS account_balance FROM supplier"""
)
def rename_redundant_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = table(spark, sf_dir, "supplier").toDF(
        "supplier_supplier_key", "name_name", "nation_key", "balance_account_balance"
    )
    return ops.rename_redundant_tokens(renamed)


@query(
    """
SELECT p_partkey, upper(p_name) AS p_name, p_brand, p_type, p_size,
       round(p_retailprice * 2, 2) AS p_retailprice FROM part"""
)
def with_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = {
        "p_name": "upper(p_name)",
        "p_retailprice": "round(p_retailprice * 2, 2)",
        "not_there": "1",
    }
    return ops.with_expressions(table(spark, sf_dir, "part"), changes)


@query("SELECT *, p_size * p_size AS area FROM part")
def with_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.with_expression(table(spark, sf_dir, "part"), "area", "p_size * p_size")


@query("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def split_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    public, _ = ops.split_pii(table(spark, sf_dir, "customer"), CUSTOMER_CATALOG, "c_custkey")
    return public


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def split_pii_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, personal = ops.split_pii(table(spark, sf_dir, "customer"), CUSTOMER_CATALOG, "c_custkey")
    return personal


@query(
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 100000 AND 300000"""
)
def filter_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ops.filter_predicate(
        table(spark, sf_dir, "orders"),
        "o_orderstatus = 'F' AND o_totalprice BETWEEN 100000 AND 300000",
    )
    return kept.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(LOADED_EVENTS + "SELECT * FROM loaded WHERE _ab_cdc_deleted_at IS NULL")
def filter_soft_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.filter_soft_deleted(loaded_events(spark, sf_dir))


@query(
    """
SELECT o_orderkey,
       CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
            THEN strftime(o_orderdate, '%Y-%m-%d') END AS ordered_on,
       CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
            THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS ordered_at
FROM orders"""
)
def nullify_sentinel_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose source wrote year 0 or year 1 for unknown dates."""
    written = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("0001-01-01").cast("timestamp_ntz"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("0000-06-15").cast("timestamp_ntz"))
        .otherwise(F.col("o_orderdate"))
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", written.cast("date").alias("ordered_on"), written.alias("ordered_at")
    )
    return ops.nullify_sentinel_dates(orders).withColumns(
        {"ordered_on": F.col("ordered_on").cast("string"), "ordered_at": second_text("ordered_at")}
    )


@query(
    """
SELECT o_orderkey,
       CASE WHEN o_orderpriority <> '5-LOW'
            THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS loaded_at, o_orderpriority AS candidate
FROM orders"""
)
def cast_timestamp_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text dates are cast, unreadable ones become NULL, and the excluded column stays text."""
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("soon")).otherwise(iso).alias("order_date"),
        F.col("o_orderdate").alias("loaded_at"),
        F.col("o_orderpriority").alias("candidate"),
    )
    cast = ops.cast_timestamp_columns(orders, exclude="candidate")
    return cast.withColumns({c: second_text(c) for c in ("order_date", "loaded_at")})


@query(
    """
SELECT doc_id, lang, source, n_chars, length(substring(text, 1, 32000)) AS kept_chars,
       md5(substring(text, 1, 32000)) AS kept_md5
FROM documents"""
)
def limit_string_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    limited = ops.limit_string_length(table(spark, sf_dir, "documents"))
    return limited.withColumns(
        {"kept_chars": F.length("text").cast("bigint"), "kept_md5": F.md5("text")}
    ).drop("text")


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_tax FROM lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return ops.distinct_rows(lines.select("l_returnflag", "l_linestatus", "l_quantity", "l_tax"))


@query("SELECT * FROM part ORDER BY p_partkey DESC LIMIT 20")
def source_sort_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_of_source(table(spark, sf_dir, "part"), "p_partkey", "desc", 20)


@query(
    """
SELECT CAST(SUM(length(CAST(o_orderkey AS VARCHAR)) + length(CAST(o_custkey AS VARCHAR))
       + length(o_orderstatus) + length(CAST(o_totalprice AS VARCHAR))
       + length(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) + length(o_orderpriority)) AS BIGINT)
       AS text_chars,
       CAST(floor(text_chars * 0.25 / 134217728) AS INTEGER) + 1 AS partitions
FROM orders"""
)
def estimate_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.estimate_size(table(spark, sf_dir, "orders"))


LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query(f"SELECT {', '.join(LINE_COLUMNS)} FROM lineitem")
def size_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.size_partitions(table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS))
