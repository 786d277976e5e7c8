"""Deduplication, merging and schema alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalode import operators as ops
from stratalode.sinks import merge_snapshot as merge_into_snapshot
from stratalode.sinks import new_folder, write_silver_parquet
from workload.fixtures import second_text, table
from workload.registry import query

KEYS = ["l_orderkey", "l_linenumber"]


@query(
    """
SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate)
FROM lineitem
QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY lineitem.l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
             l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
             l_linestatus DESC
) = 1"""
)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = ops.dedup_latest(table(spark, sf_dir, "lineitem"), KEYS, "l_shipdate")
    return latest.withColumn("l_shipdate", second_text("l_shipdate"))


def incoming_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed on customers: new balances, closed accounts, suppliers as new customers.

    Each change comes twice, the older version with the balance it corrects.
    """
    customers = table(spark, sf_dir, "customer").filter(
        F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")
    )
    changed = customers.select(
        "c_custkey",
        "c_nationkey",
        F.round(F.col("c_acctbal") + 100, 2).alias("c_acctbal"),
        "c_mktsegment",
        F.lit("known").alias("tier"),
        (F.col("c_mktsegment") == "HOUSEHOLD").alias("closed"),
    )
    opened = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLY").alias("c_mktsegment"),
        F.lit("new").alias("tier"),
        (F.col("s_acctbal") < 0).alias("closed"),
    )
    newer = changed.unionByName(opened).withColumn("_ab_cdc_updated_at", F.lit(2))
    older = newer.withColumns({"c_acctbal": F.lit(0.0), "_ab_cdc_updated_at": F.lit(1)})
    return (
        newer.unionByName(older)
        .withColumn("_ab_cdc_deleted_at", F.when(F.col("closed"), F.col("_ab_cdc_updated_at")))
        .drop("closed")
    )


FEED = """
WITH feed AS (
    SELECT c_custkey, c_nationkey, round(c_acctbal + 100, 2) AS c_acctbal, c_mktsegment,
           'known' AS tier, c_mktsegment = 'HOUSEHOLD' AS closed
    FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD')
    UNION ALL
    SELECT -1 - s_suppkey, s_nationkey, s_acctbal, 'SUPPLY', 'new', s_acctbal < 0 FROM supplier
)"""


@query(
    FEED
    + """
SELECT c_custkey, c_name, c_nationkey, coalesce(f.c_acctbal, c.c_acctbal) AS c_acctbal,
       c.c_mktsegment, f.tier
FROM customer c LEFT JOIN feed f USING (c_custkey, c_nationkey)
WHERE f.closed IS NOT TRUE
UNION ALL
SELECT c_custkey, NULL, c_nationkey, c_acctbal, c_mktsegment, tier
FROM feed WHERE c_custkey < 0 AND NOT closed"""
)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.merge_upsert(
        table(spark, sf_dir, "customer"), incoming_customers(spark, sf_dir), "c_custkey"
    )


@query(
    FEED
    + """
SELECT c_custkey, c_name, c_nationkey, coalesce(f.c_acctbal, c.c_acctbal) AS c_acctbal,
       c.c_mktsegment, f.tier
FROM customer c LEFT JOIN feed f USING (c_custkey, c_nationkey)
WHERE f.closed IS NOT TRUE
UNION ALL
SELECT c_custkey, NULL, c_nationkey, c_acctbal, c_mktsegment, tier
FROM feed WHERE c_custkey < 0 AND NOT closed
UNION ALL
SELECT NULL, NULL, n_nationkey, n_nationkey, 'UNKNOWN', 'keyless' FROM nation WHERE n_nationkey % 3 <> 0"""
)
def merge_upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed with changes that have no key: each is inserted, but for the deletions."""
    keyless = table(spark, sf_dir, "nation").select(
        F.lit(None).cast("bigint").alias("c_custkey"),
        F.col("n_nationkey").alias("c_nationkey"),
        F.col("n_nationkey").cast("double").alias("c_acctbal"),
        F.lit("UNKNOWN").alias("c_mktsegment"),
        F.lit("keyless").alias("tier"),
        F.lit(2).alias("_ab_cdc_updated_at"),
        F.when(F.col("n_nationkey") % 3 == 0, F.lit(2)).alias("_ab_cdc_deleted_at"),
    )
    feed = incoming_customers(spark, sf_dir).unionByName(keyless)
    return ops.merge_upsert(table(spark, sf_dir, "customer"), feed, "c_custkey")


# Without technical columns in the stored table, the newest version of an open account wins.
MERGED = (
    FEED
    + """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS tier
FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL
SELECT c_custkey, NULL, c_nationkey, c_acctbal, c_mktsegment, tier FROM feed WHERE NOT closed"""
)


@query(MERGED)
def merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = ops.merge_dedup(
        table(spark, sf_dir, "customer"), incoming_customers(spark, sf_dir), "c_custkey"
    )
    return ops.drop_cdc_columns(merged)


@query(MERGED)
def merge_dedup_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge, leaving stored rows whose key does not come in where they are."""
    merged = ops.merge_dedup(
        table(spark, sf_dir, "customer"),
        incoming_customers(spark, sf_dir),
        "c_custkey",
        existing_is_unique=True,
    )
    return ops.drop_cdc_columns(merged)


@query(MERGED)
def merge_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge between two dated snapshots on storage."""
    root = new_folder(spark, "snapshots")
    write_silver_parquet(table(spark, sf_dir, "customer"), root, "customer", "2024-05-31")
    merged = merge_into_snapshot(
        spark, incoming_customers(spark, sf_dir), root, "customer", "2024-06-01", "c_custkey"
    )
    return ops.drop_cdc_columns(merged)


@query(
    FEED
    + """
SELECT c_custkey, c_name, c_nationkey, coalesce(f.c_acctbal, c.c_acctbal) AS c_acctbal,
       c.c_mktsegment, f.tier
FROM customer c LEFT JOIN feed f USING (c_custkey, c_nationkey)
WHERE f.closed IS NOT TRUE
UNION ALL
SELECT c_custkey, NULL, c_nationkey, c_acctbal, c_mktsegment, tier
FROM feed WHERE c_custkey < 0 AND NOT closed"""
)
def merge_snapshot_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed accounts leave the stored table."""
    root = new_folder(spark, "snapshots")
    write_silver_parquet(table(spark, sf_dir, "customer"), root, "customer", "2024-05-31")
    merged = merge_into_snapshot(
        spark, incoming_customers(spark, sf_dir), root, "customer", "2024-06-01", "c_custkey", how="upsert"
    )
    return ops.drop_cdc_columns(merged)


@query(
    """
SELECT c_custkey, c_name, c_nationkey,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN round(c_acctbal + 7, 2) ELSE c_acctbal END AS c_acctbal,
       c_mktsegment, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 7 ELSE 5 END AS _airbyte_extracted_at
FROM customer"""
)
def merge_snapshot_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change of version 3 arrives after version 5 was stored, and one of version 7."""
    root = new_folder(spark, "snapshots")
    customers = table(spark, sf_dir, "customer")
    days = (("2024-05-30", "c_mktsegment is not null", 5), ("2024-05-31", "c_mktsegment = 'BUILDING'", 3), ("2024-06-01", "c_mktsegment = 'HOUSEHOLD'", 7))
    for day, which, version in days:
        changed = customers.filter(which).withColumns({
            "c_acctbal": F.round(F.col("c_acctbal") + (0 if version == 5 else version), 2),
            "_airbyte_extracted_at": F.lit(version),
        })
        merged = merge_into_snapshot(
            spark, changed, root, "customer", day, "c_custkey", "_airbyte_extracted_at", existing_is_unique=True
        )
    return merged


@query(MERGED)
def merge_snapshot_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge of two days in buckets; the second stays a rerun of itself."""
    root = new_folder(spark, "snapshots")
    customers = table(spark, sf_dir, "customer")
    merge_into_snapshot(spark, customers, root, "customer", "2024-05-31", "c_custkey", buckets=8)
    for _ in range(2):
        merged = merge_into_snapshot(
            spark, incoming_customers(spark, sf_dir), root, "customer", "2024-06-01", "c_custkey", buckets=8
        )
    return ops.drop_cdc_columns(merged)


@query(
    FEED
    + """
SELECT c_custkey, c_name, c_nationkey, coalesce(f.c_acctbal, c.c_acctbal) AS c_acctbal,
       c.c_mktsegment, f.tier
FROM customer c LEFT JOIN feed f USING (c_custkey, c_nationkey)
WHERE f.closed IS NOT TRUE
UNION ALL
SELECT c_custkey, NULL, c_nationkey, c_acctbal, c_mktsegment, tier
FROM feed WHERE c_custkey < 0 AND NOT closed"""
)
def merge_snapshot_bucketed_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed accounts leave a table kept in buckets."""
    root = new_folder(spark, "snapshots")
    merge_into_snapshot(spark, table(spark, sf_dir, "customer"), root, "customer", "2024-05-31", "c_custkey", buckets=8)
    merged = merge_into_snapshot(
        spark, incoming_customers(spark, sf_dir), root, "customer", "2024-06-01", "c_custkey", how="upsert", buckets=8
    )
    return ops.drop_cdc_columns(merged)


# Accounts of one segment were closed in version 9. Versions 7 and 9 that arrive later do not
# bring them back, version 11 does; a change of version 7 to an open account is taken.
LATE_AFTER_DELETE = """
SELECT c_custkey, c_name, c_nationkey,
       round(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_acctbal + 11 WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 7 ELSE c_acctbal END, 2) AS c_acctbal,
       c_mktsegment, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 11 WHEN 'BUILDING' THEN 7 ELSE 5 END AS _ab_cdc_updated_at
FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' OR c_custkey % 4 = 0"""


def late_after_delete(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    root = new_folder(spark, "snapshots")
    customers = table(spark, sf_dir, "customer")

    def change(which: str, version: int, deleted: bool = False) -> DataFrame:
        return customers.filter(which).withColumns({
            "c_acctbal": F.round(F.col("c_acctbal") + (0 if version == 5 else version), 2),
            "_ab_cdc_updated_at": F.lit(version),
            "_ab_cdc_deleted_at": F.lit(version if deleted else None).cast("int"),
        })

    household = "c_mktsegment = 'HOUSEHOLD'"
    days = {
        "2024-05-30": change("c_custkey is not null", 5),
        "2024-05-31": change(household, 9, deleted=True),
        "2024-06-01": change("c_mktsegment in ('HOUSEHOLD', 'BUILDING') and c_custkey % 2 = 0", 7).unionByName(
            change("c_mktsegment in ('BUILDING') and c_custkey % 2 = 1", 7)
        ),
        "2024-06-02": change(f"{household} and c_custkey % 4 = 1", 9).unionByName(change(f"{household} and c_custkey % 4 = 0", 11)),
        "2024-06-03": change(f"{household} and c_custkey % 4 = 0", 10, deleted=True).unionByName(change(f"{household} and c_custkey % 4 = 2", 8)),
    }
    for day, feed in days.items():
        merged = merge_into_snapshot(
            spark, feed, root, "customer", day, "c_custkey", how="upsert", tombstone_days=30, **options
        )
    return merged


@query(LATE_AFTER_DELETE)
def merge_snapshot_late_after_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that arrive after their account was closed by a newer one."""
    return late_after_delete(spark, sf_dir)


@query(LATE_AFTER_DELETE)
def merge_snapshot_late_after_delete_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the table in buckets."""
    return late_after_delete(spark, sf_dir, buckets=8)


@query(
    """
SELECT *, CAST(NULL AS BIGINT) AS s_suppkey, CAST(NULL AS VARCHAR) AS s_name,
       CAST(NULL AS INTEGER) AS s_nationkey, CAST(NULL AS DOUBLE) AS s_acctbal
FROM customer"""
)
def align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.align_columns(table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier"))
