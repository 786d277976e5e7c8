"""Sources and sinks: each query writes the driver's rows, reads them back and returns them.

Reading from and writing to a database is not among them: that needs a running
database, and the session has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalode import operators as ops
from stratalode import plans, sinks, sources
from workload.fixtures import CREATED_AT, cart_lines, events, flat_products, table
from workload.indicators import PERFORMANCE, cents, stamped
from workload.registry import query

EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, ts_micros bigint"
DATED_SCHEMA = EVENT_SCHEMA + ", year int, month int, day int"


def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "ts_micros", "ts")


def dated_json(spark: SparkSession, sf_dir: str) -> str:
    """Events landed as JSON under their own days; returns the bronze root."""
    root = sinks.new_folder(spark, "bronze")
    sinks.land_bronze_json(flat_events(spark, sf_dir), root, "events", date_column="ts")
    return root


def dated_parquet(spark: SparkSession, sf_dir: str) -> str:
    """Events as a Parquet table with date partitions; returns the table's root."""
    root = sinks.new_folder(spark, "silver")
    sinks.write_silver_parquet(flat_events(spark, sf_dir), root, "events", date_column="ts")
    return f"{root}/events"


EVENTS = "SELECT event_id, user_id, event_type, value, epoch_us(ts) AS ts_micros FROM events"
DATED_EVENTS = """
SELECT event_id, user_id, event_type, value, epoch_us(ts) AS ts_micros,
       CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day
FROM events"""


@query(EVENTS + " WHERE value > 20")
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.new_folder(spark, "json")
    flat_events(spark, sf_dir).drop("ts").write.json(path)
    return sources.scan_json(spark, path, "value > 20", EVENT_SCHEMA)


@query(
    EVENTS.replace(" FROM", ", CASE WHEN event_type = 'click' THEN user_id END AS clicked_by FROM")
)
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files of different schema, found under the table's name and merged."""
    folder = sinks.new_folder(spark, "parquet")
    rows = flat_events(spark, sf_dir).drop("ts")
    is_click = F.col("event_type") == "click"
    path = f"{folder}/events.parquet"
    rows.filter(~is_click).write.parquet(path)
    clicks = rows.filter(is_click).withColumn("clicked_by", F.col("user_id"))
    clicks.write.mode("append").parquet(path)
    return sources.scan_parquet(spark, folder, table="events")


@query(DATED_EVENTS)
def scan_partitioned_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = dated_parquet(spark, sf_dir)
    return sources.scan_partitioned_root(spark, root).drop("ts")


@query(DATED_EVENTS + " WHERE date_trunc('day', ts) = (SELECT max(date_trunc('day', ts)) FROM events)")
def scan_partitioned_root_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = dated_parquet(spark, sf_dir)
    return sources.scan_partitioned_root(spark, root, snapshot="latest").drop("ts")


@query(DATED_EVENTS + " WHERE date_trunc('day', ts) = DATE '2024-01-15'")
def scan_execution_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = dated_json(spark, sf_dir)
    return sources.scan_execution_date(
        spark, root, "events", "2024-01-15", schema=DATED_SCHEMA
    )


@query(EVENTS)
def scan_execution_date_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks in one file of their own, views below a common beginning, the rest in a day's folder."""
    root = sinks.new_folder(spark, "bronze")
    rows = flat_events(spark, sf_dir).drop("ts")
    is_click, is_view = F.col("event_type") == "click", F.col("event_type") == "view"
    rows.filter(is_click).write.json(f"{root}/clicks.json")
    rows.filter(is_view).write.json(f"{root}/shop_views.json")
    sinks.land_bronze_json(rows.filter(~is_click & ~is_view), root, "rest", "2024-06-01")
    parts = [
        sources.scan_execution_date(spark, f"{root}/clicks.json", schema=EVENT_SCHEMA),
        sources.scan_execution_date(spark, f"{root}/shop_", "views", schema=EVENT_SCHEMA),
        sources.scan_execution_date(spark, f"{root}/rest/year=2024/month=06/day=01", schema=DATED_SCHEMA).drop("year", "month", "day"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(DATED_EVENTS + " WHERE day(ts) BETWEEN 8 AND 17")
def scan_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = dated_parquet(spark, sf_dir)
    return sources.scan_date_range(spark, root, "2024-01-08", "2024-01-17").drop("ts")


@query(DATED_EVENTS + " WHERE ts < TIMESTAMP '2024-01-06 00:00:00'")
def scan_date_range_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range that starts in the year before the data; the wide form would keep all of it."""
    root = dated_parquet(spark, sf_dir)
    return sources.scan_date_range(spark, root, "2023-12-20", "2024-01-05", exact=True).drop("ts")


@query("SELECT unnest(string_split(p_name, ' ')) AS category FROM part")
def scan_json_string_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.new_folder(spark, "lists")
    words = F.to_json(F.split("p_name", " ")).alias("value")
    table(spark, sf_dir, "part").select(words).write.text(path)
    return sources.scan_json_string_list(spark, path, "category")


@query(EVENTS + " WHERE event_type <> 'error'")
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in a format other than Parquet, read by location with a predicate."""
    location = sinks.new_folder(spark, "orc")
    sinks.write_table(flat_events(spark, sf_dir).drop("ts"), location, fmt="orc")
    return sources.scan_table(spark, location, "orc", "event_type <> 'error'")


@query(DATED_EVENTS)
def land_bronze_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = dated_json(spark, sf_dir)
    return sources.scan_json(spark, f"{root}/events", schema=DATED_SCHEMA)


@query(
    """
SELECT o_orderkey, o_custkey, o_totalprice, 2024 AS year, 6 AS month, 1 AS day FROM orders"""
)
def write_silver_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice for one execution date: the second write replaces the first."""
    root = sinks.new_folder(spark, "silver")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    for _ in range(2):
        sinks.write_silver_parquet(orders, root, "orders", "2024-06-01")
    return sources.scan_partitioned_root(spark, f"{root}/orders")


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def write_gold_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.new_folder(spark, "gold")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"
    )
    sinks.write_gold_parquet(orders, path, "o_orderstatus")
    return sources.scan_parquet(spark, path, merge_schema=False)


@query(
    """
SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'
UNION ALL
SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'click'"""
)
def write_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a table from a change feed, then append the clicks once more."""
    location = sinks.table_location(sinks.new_folder(spark, "tables"), "events", "sales", "web")
    feed = flat_events(spark, sf_dir).select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("ts_micros").alias("_airbyte_extracted_at"),
        F.when(F.col("event_type") == "error", F.col("ts_micros")).alias("_ab_cdc_deleted_at"),
    )
    sinks.write_table(feed, location)
    sinks.write_table(feed.filter("event_type = 'click'"), location)
    return sources.scan_table(spark, location)


@query(
    """
SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS is_final, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS ordered_on,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered_at,
       '[' || o_orderkey || ',' || o_custkey || ']' AS ids,
       '{"status":"' || o_orderstatus || '","priority":"' || o_orderpriority || '"}' AS state,
       '{"' || o_orderstatus || '":' || o_custkey || '}' AS by_status
FROM orders"""
)
def relational_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").alias("is_final"),
        "o_totalprice",
        F.to_date("o_orderdate").alias("ordered_on"),
        F.col("o_orderdate").alias("ordered_at"),
        F.array("o_orderkey", "o_custkey").alias("ids"),
        F.struct(
            F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
        ).alias("state"),
        F.create_map("o_orderstatus", "o_custkey").alias("by_status"),
    )
    return sinks.relational_projection(typed)


@query(PERFORMANCE)
def conform_to_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product performance with all columns as text and one too many, brought to the contract."""
    performance = plans.product_performance(
        cart_lines(spark, sf_dir), flat_products(spark, sf_dir), CREATED_AT
    )
    as_text = performance.select(*[F.col(c).cast("string") for c in reversed(performance.columns)])
    contract = plans.GOLD_TABLES["product_performance"]
    conformed = plans.conform_to_schema(as_text.withColumn("extra", F.lit(1)), contract.schema)
    return stamped(cents(conformed))


BROKEN_LINES = """
WITH lines AS (
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS shipped
    FROM lineitem
), by_key AS (
    SELECT l_orderkey || ',' || l_linenumber AS key, COUNT(*) AS rows,
           COUNT(*) FILTER (WHERE shipped IS NULL) AS unshipped
    FROM lines GROUP BY l_orderkey, l_linenumber
)
SELECT 'primary_key' AS rule, 'l_orderkey,l_linenumber' AS column_name, key, rows AS row_count
FROM by_key WHERE rows > 1
UNION ALL
SELECT 'not_null', 'shipped', key, unshipped FROM by_key WHERE unshipped > 0"""


@query(BROKEN_LINES)
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose key repeats, and returned ones as rows without a ship date."""
    return plans.constraint_violations(shipped_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], "shipped")


def shipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("shipped")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", shipped, "l_partkey")


@query(BROKEN_LINES)
def constraint_violations_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by four days that come out of order, the last of them twice."""
    root = sinks.new_folder(spark, "checked")
    lines = shipped_lines(spark, sf_dir).withColumn("part", F.pmod(F.coalesce("l_partkey", F.lit(0)), F.lit(4)))
    for day, part in ((1, 0), (3, 1), (2, 2), (4, 3), (4, 3)):
        found = plans.constraint_violations_incremental(
            lines.where(F.col("part") == part), root, "lineitem", f"2024-06-0{day}", ["l_orderkey", "l_linenumber"], "shipped", buckets=4
        )
    return found


@query("SELECT event_id, user_id, event_type, value, epoch_us(ts) AS ts_micros FROM events")
def scan_since_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days by four runs since a mark: one to the middle, one that fails, one to the end, one for a day that came late."""
    root, out = sinks.new_folder(spark, "silver"), sinks.new_folder(spark, "marked")
    rows = flat_events(spark, sf_dir)
    days = sorted(r[0] for r in rows.select(F.to_date("ts")).distinct().collect())
    late, middle = days[len(days) // 3], days[len(days) // 2]
    is_late = F.to_date("ts") == F.lit(late)
    sinks.write_silver_parquet(rows.where(~is_late), root, "events", date_column="ts")

    def run(number: int, current, fails: bool = False) -> None:
        with sources.since_mark(spark, f"{root}/events", f"{out}/mark.json", current) as todo:
            sinks.write_silver_parquet(todo.rows.drop("year", "month", "day"), out, f"run{number}")
            if fails:
                raise RuntimeError("after it has written")

    run(1, middle)
    try:
        run(2, days[-1], fails=True)
    except RuntimeError:
        run(2, days[-1])
    sinks.write_silver_parquet(rows.where(is_late), root, "events", date_column="ts")
    run(3, days[-1])
    runs = [spark.read.parquet(f"{out}/run{n}").drop("ts", "year", "month", "day") for n in (1, 2, 3)]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


@query("SELECT event_id, user_id, event_type, value, epoch_us(ts) AS ts_micros FROM events")
def write_table_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named table to which two days are appended, the second one twice."""
    name = "events_by_day"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = flat_events(spark, sf_dir).drop("ts")
    days = {"2024-05-31": rows.where("event_id % 3 = 0"), "2024-06-01": rows.where("event_id % 3 <> 0")}
    for day, part in (*days.items(), ("2024-06-01", days["2024-06-01"])):
        sinks.write_table(part, name, execution_date=day)
    found = sources.scan_table(spark, name).drop("year", "month", "day")
    written = sinks.stage(found, "events-by-day")
    spark.sql(f"DROP TABLE {name}")
    return written


CUSTOMER_ORDERS = """
WITH parts AS (SELECT *, coalesce(o_orderkey, 0) % 3 AS part FROM orders)
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer,
       CASE WHEN part = 0 THEN floor(o_totalprice) ELSE o_totalprice END AS amount,
       CASE WHEN part <> 0 THEN o_orderstatus END AS status,
       CASE WHEN part = 2 THEN o_orderpriority END AS priority, 2024 AS year, 6 AS month,
       CAST(part + 1 AS INTEGER) AS day
FROM parts"""


@query(CUSTOMER_ORDERS)
def scan_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days with three schemas: columns widen to long, double and text, a struct comes and gains a field."""
    root = sinks.new_folder(spark, "evolving")
    orders = table(spark, sf_dir, "orders").withColumn("part", F.pmod(F.coalesce("o_orderkey", F.lit(0)), F.lit(3)))
    status, priority = F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
    days = (
        (F.col("o_orderkey").cast("int"), F.col("o_custkey").cast("int"), F.floor("o_totalprice").cast("int")),
        (F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice"), F.struct(status).alias("state")),
        (F.col("o_orderkey"), F.col("o_custkey").cast("string"), F.col("o_totalprice"), F.struct(status, priority).alias("state")),
    )
    for part, (key, customer, amount, *state) in enumerate(days):
        rows = orders.where(F.col("part") == part).select(
            key.alias("o_orderkey"), customer.alias("customer"), amount.alias("amount"), *state
        )
        sinks.write_silver_parquet(rows, root, "orders", f"2024-06-0{part + 1}", declare=part != 1)
    found = sources.scan_evolving(spark, f"{root}/orders")
    return found.select("*", "state.status", "state.priority").drop("state")


@query("SELECT o_orderkey, o_custkey, o_totalprice, 2024 AS year, 6 AS month, 1 AS day FROM orders")
def write_silver_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in sorted ranges of their customers."""
    root = sinks.new_folder(spark, "clustered")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    sinks.write_silver_parquet(orders, root, "orders", "2024-06-01", cluster_by="o_custkey")
    return sources.scan_partitioned_root(spark, f"{root}/orders")


@query("SELECT COUNT(*) AS row_count, TRUE AS has_files FROM lineitem")
def estimate_stored_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and size of a stored table from listings and footers; the bytes vary with the writer."""
    sized = ops.estimate_stored_size(table(spark, sf_dir, "lineitem"))
    filled = (F.col("files") > 0) & (F.col("stored_bytes") > 0) & (F.col("partitions") > 0)
    return sized.select("row_count", filled.alias("has_files"))
