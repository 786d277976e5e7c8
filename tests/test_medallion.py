import importlib
import json
import os

import pytest
from pyspark.sql import functions as F

from stratalode import plans, sinks, sources
from stratalode.plans.silver import RAW_SCHEMAS

stage_module = importlib.import_module("stratalode.sinks.stage")

PRODUCTS = [
    {"id": 1, "title": "shirt", "price": 10.0, "description": "d", "category": "men", "image": "i",
     "rating": {"rate": 3.9, "count": 120}},
    {"id": 2, "title": "ring", "price": 5.5, "description": "d", "category": "jewels", "image": "i",
     "rating": {"rate": 4.1, "count": 70}},
]
CARTS = [
    {"id": 1, "userId": 1, "date": "2020-03-02T00:00:00.000Z", "__v": 0,
     "products": [{"productId": 1, "quantity": 4}, {"productId": 2, "quantity": 1}]},
    {"id": 2, "userId": 1, "date": "2020-01-02T00:00:00.000Z", "__v": 0,
     "products": [{"productId": 2, "quantity": 2}]},
    {"id": 2, "userId": 1, "date": "2019-01-02T00:00:00.000Z", "__v": 1,
     "products": [{"productId": 1, "quantity": 1}]},
    {"id": 3, "userId": 2, "date": "2020-03-02T00:00:00.000Z", "__v": 0, "products": []},
    {"id": 4, "userId": 2, "date": "2020-03-02T00:00:00.000Z", "__v": 0,
     "products": [{"productId": 99, "quantity": 1}]},
]


@pytest.fixture
def bronze(tmp_path):
    """One day as a single-line JSON array per table, the way an API returns it."""
    for table, documents in {"products": PRODUCTS, "carts": CARTS, "empty": []}.items():
        folder = tmp_path / "bronze" / table / "year=2024" / "month=01" / "day=05"
        folder.mkdir(parents=True)
        (folder / f"{table}.json").write_text(json.dumps(documents))
    return str(tmp_path / "bronze")


def test_silver_columns_and_rows(spark, bronze, rows):
    raw = sources.scan_execution_date(spark, bronze, "products", "2024-01-05")
    products = plans.silver_products(raw)
    assert products.columns == [
        "category", "description", "id", "image", "price", "rating_count", "rating_rate", "title",
    ]
    carts = plans.silver_carts(sources.scan_execution_date(spark, bronze, "carts", "2024-01-05"))
    assert carts.columns == ["__v", "date", "id", "userId", "products_productId", "products_quantity"]
    assert dict(carts.dtypes)["date"] == "timestamp"
    assert rows(carts.select("id", "products_productId", "products_quantity")) == [
        (1, 1, 4), (1, 2, 1), (2, 1, 1), (3, None, None), (4, 99, 1),
    ]


def test_declared_raw_schemas_equal_the_inferred_ones(spark, bronze):
    for table, schema in RAW_SCHEMAS.items():
        inferred = sources.scan_execution_date(spark, bronze, table, "2024-01-05")
        declared = sources.scan_execution_date(spark, bronze, table, "2024-01-05", schema=schema)
        assert inferred.dtypes == declared.dtypes


def test_cleaning_order(spark):
    """The placeholder check sees dates only: text that becomes one later is not checked."""
    df = spark.createDataFrame(
        [(1, 1, "0001-01-01", "abcdef", None, "r", 2024)],
        "id int, updated_at int, start_date string, s string, a array<int>, _airbyte_r string, year int",
    ).withColumn("d", F.lit("0001-01-01").cast("date"))
    out = plans.process_table(df, string_limit=12, expressions={"twice": "id * 2", "same": ""})
    assert out.columns == ["id", "updated_at", "start_date", "s", "a", "d", "twice"]
    row = out.select(F.col("start_date").cast("string"), "d", "a", "twice").first()
    assert tuple(row) == ("0001-01-01 00:00:00", None, [], 2)


def test_only_incremental_tables_are_deduplicated(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "id int, updated_at int")
    assert plans.process_table(df).count() == 1
    assert plans.process_table(df, incremental=False).count() == 2
    assert plans.process_and_flatten(df, partitions=1).count() == 1
    no_key = df.withColumnRenamed("id", "k")
    assert plans.process_table(no_key, incremental=False).count() == 2
    with pytest.raises(ValueError):
        plans.process_table(no_key)


@pytest.mark.parametrize("concurrency", [1, 4])
def test_many_tables(spark, bronze, tmp_path, concurrency):
    silver = str(tmp_path / "silver")
    written = plans.process_tables(
        spark, bronze, silver, ["products", "carts", "empty"], "2024-01-05",
        subdomain="shop", concurrency=concurrency, schemas={"empty": "id int"},
    )
    assert written == {
        "products": f"{silver}/shop_products/year=2024/month=01/day=05",
        "carts": f"{silver}/shop_carts/year=2024/month=01/day=05",
        "empty": None,
    }
    assert spark.read.parquet(written["carts"]).count() == 5


def test_declared_keys_and_overwritten_tables(spark, bronze, tmp_path):
    def rows_written(**options):
        written = plans.process_tables(
            spark, bronze, str(tmp_path / "s"), ["carts"], "2024-01-05",
            schemas=RAW_SCHEMAS, **options,
        )
        return spark.read.parquet(written["carts"]).count()

    by_user = {"columns_description": [{"column": "userid", "primary_key": True}]}
    assert rows_written() == 5
    assert rows_written(catalogs={"carts": by_user}) == 2
    assert rows_written(write_modes={"carts": "overwrite"}) == 6


def test_plain_copy_and_table_formats(spark, bronze, tmp_path):
    copied = plans.process_tables(
        spark, bronze, str(tmp_path / "el"), ["products"], "2024-01-05", mode="EL"
    )
    assert "rating" in spark.read.parquet(copied["products"]).columns
    tables = plans.process_tables(
        spark, bronze, str(tmp_path / "orc"), ["products"], "2024-01-05",
        target_format="orc", domain="sales", subdomain="shop",
    )
    assert tables["products"].endswith("/orc/sales/shop/shop_products")
    assert sources.scan_table(spark, tables["products"], "orc").count() == 2
    with pytest.raises(ValueError):
        plans.process_tables(spark, bronze, "x", [], mode="LT")


def test_one_failing_table_fails_the_batch(spark, bronze, tmp_path):
    def broken(df):
        raise RuntimeError("cannot clean this")

    with pytest.raises(RuntimeError, match="cannot clean"):
        plans.process_tables(
            spark, bronze, str(tmp_path / "s"), ["products", "carts"], "2024-01-05",
            transforms={"carts": broken},
        )


def test_custom_transform_replaces_the_default(spark, bronze, tmp_path):
    written = plans.process_tables(
        spark, bronze, str(tmp_path / "s"), ["products"], "2024-01-05",
        transforms={"products": lambda df: df.select("id")},
    )
    assert spark.read.parquet(written["products"]).columns == ["id"]


def test_whole_run_and_rerun(spark, bronze, tmp_path, rows):
    raw = {t: spark.read.schema(s).json(f"{bronze}/{t}/*/*/*") for t, s in RAW_SCHEMAS.items()}
    root = str(tmp_path / "lake")
    for day in ("2024-01-05", "2024-01-06", "2024-01-06"):
        paths = plans.run_pipeline(spark, raw, root, day, "2024-06-01 00:00:00", subdomain="shop")
    gold = {name: spark.read.parquet(path) for name, path in paths.items()}
    assert set(gold) == set(plans.GOLD_TABLES)
    for name, df in gold.items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in plans.GOLD_TABLES[name].schema
        ]
    assert rows(gold["top10_products_revenue"].select("product_id", "total_units_sold", "total_revenue")) == [
        (1, 5, 50.0), (2, 1, 5.5),
    ]
    assert rows(gold["category_performance"].select("category", "total_revenue", "revenue_share_pct")) == [
        ("jewels", 5.5, 0.0991), ("men", 50.0, 0.9009), (None, None, None),
    ]
    assert rows(gold["user_ltv"].select("user_id", "total_orders", "avg_ticket", "customer_type")) == [
        (1, 2, 27.75, "recurrent"), (2, 2, None, "recurrent"),
    ]
    everything = plans.run_pipeline(spark, raw, root, "2024-01-06", subdomain="shop", snapshot="all")
    doubled = spark.read.parquet(everything["top10_products_revenue"])
    assert doubled.filter("product_id = 1").first().total_units_sold == 5 * 2 * 2


def test_staged_and_lazy_gold_agree(spark, bronze, rows):
    carts = plans.silver_carts(sources.scan_execution_date(spark, bronze, "carts", "2024-01-05"))
    products = plans.silver_products(sources.scan_execution_date(spark, bronze, "products", "2024-01-05"))
    staged = plans.build_gold(carts, products, "2024-06-01")
    lazy = plans.build_gold(carts, products, "2024-06-01", staged=False)
    for name in plans.GOLD_TABLES:
        assert rows(staged[name]) == rows(lazy[name])


def test_gold_copies_share_one_load_time(spark, tmp_path, monkeypatch):
    from stratalode.plans import gold

    copies = {}
    monkeypatch.setattr(
        gold, "write_jdbc", lambda df, url, name, properties=None: copies.update({name: df.first()[0]})
    )
    stamped = spark.range(1).select(F.current_timestamp().alias("created_at"))
    paths = plans.write_gold_tables({"t": stamped}, str(tmp_path), jdbc_url="jdbc:x")
    assert copies["t"] == spark.read.parquet(paths["t"]).first()[0]
    assert sinks.table_location(str(tmp_path), "t") == paths["t"]


def test_backfilled_day_publishes_its_own_figures(spark, tmp_path):
    """A later day runs first; the earlier one must not read its prices."""

    def raw(price):
        products = spark.createDataFrame([(1, "t", "c", price)], "id bigint, title string, category string, price double")
        products = products.selectExpr("*", "'d' AS description", "'i' AS image", "struct(1L AS count, 1.0D AS rate) AS rating")
        carts = spark.sql(
            "SELECT 1L AS id, 1L AS userId, '2024-05-01' AS date, 0L AS __v, array(struct(1L AS productId, 1L AS quantity)) AS products"
        )
        return {"products": products, "carts": carts}

    home = sinks.new_folder(spark, "x").rpartition("/")[0].removeprefix("file:")

    def staged():
        return sorted(os.listdir(home)) if os.path.isdir(home) else []

    before = staged()
    for price, day, revenue in ((100.0, "2024-06-02", 100.0), (5.0, "2024-06-01", 5.0)):
        paths = plans.run_pipeline(spark, raw(price), str(tmp_path), day, f"{day} 00:00:00")
        assert spark.read.parquet(paths["product_performance"]).first()["total_revenue"] == revenue
    assert staged() == before


def test_cleaning_keeps_long_text_and_columns_that_sound_like_dates(spark):
    df = spark.createDataFrame([(1, "x" * 40_000, "maria", "2024-01-01")], "id int, text string, updated_by string, due_date string")
    row = plans.process_table(df, not_timestamps=["updated_by"]).first()
    assert len(row["text"]) == 40_000 and row["updated_by"] == "maria" and row["due_date"].year == 2024
    flat = plans.process_and_flatten(df, not_timestamps=["updated_by"]).first()
    assert flat["updated_by"] == "maria"


def test_findings_of_written_gold_tables_are_logged(spark, tmp_path, caplog):
    products = spark.createDataFrame([(1, "t", "c", 2.0, 1, 1.0)], "id bigint, title string, category string, price double, rating_count bigint, rating_rate double")
    carts = spark.createDataFrame([(1, 1, 99, 1)], "id bigint, userId bigint, products_productId bigint, products_quantity bigint")
    carts = carts.withColumn("date", F.lit("2024-01-01").cast("timestamp"))
    with caplog.at_level("WARNING"):
        plans.write_gold_tables(plans.build_gold(carts, products, "2024-01-01 00:00:00"), str(tmp_path))
    assert any("product_performance" in m and "not_null" in m and "product_id" in m for m in caplog.messages)


def test_whole_run_lands_compressed_json(spark, bronze, tmp_path, rows):
    raw = {t: spark.read.schema(s).json(f"{bronze}/{t}/*/*/*") for t, s in RAW_SCHEMAS.items()}
    plans.run_pipeline(spark, raw, str(tmp_path / "lake"), "2024-01-05")
    for table, schema in RAW_SCHEMAS.items():
        day = tmp_path / "lake" / "bronze" / table / "year=2024" / "month=01" / "day=05"
        landed = [f.name for f in day.iterdir() if f.name.startswith("part-")]
        assert landed and all(name.endswith(".json.gz") for name in landed)
        assert rows(spark.read.schema(schema).json(str(day))) == rows(raw[table])


def test_incremental_run_copies_no_stored_lines_or_states(spark, bronze, tmp_path, rows, monkeypatch):
    raw = {t: spark.read.schema(s).json(f"{bronze}/{t}/*/*/*") for t, s in RAW_SCHEMAS.items()}
    written, copies = stage_module._written, []

    def noted(df, path):
        copies.append(path.rsplit("/", 1)[1].rsplit("-", 1)[0])
        return written(df, path)

    monkeypatch.setattr(stage_module, "_written", noted)
    lake = str(tmp_path / "lake")
    created = "2024-01-05 00:00:00"
    found = plans.run_pipeline(spark, raw, lake, "2024-01-05", created, incremental=True)
    assert sorted(copies) == ["changed-lines", "units_by_product"]
    copies.clear()
    found = plans.run_pipeline(spark, raw | {"carts": raw["carts"].where("id = 1")}, lake, "2024-01-06", created, incremental=True)
    assert sorted(copies) == ["by_date", "by_user", "changed-lines", "units_by_product"]
    whole = plans.run_pipeline(spark, raw, str(tmp_path / "whole"), "2024-01-05", created)
    for name, path in found.items():
        assert rows(spark.read.parquet(path)) == rows(spark.read.parquet(whole[name])), name


def test_whole_carts_are_counted_without_another_shuffle(spark, bronze, tmp_path, rows, plan):
    written = plans.process_tables(spark, bronze, str(tmp_path / "silver"), ["products", "carts"], "2024-01-05")
    carts, products = (spark.read.parquet(written[t]) for t in ("carts", "products"))
    created = "2024-01-05 00:00:00"
    apart, whole = (plans.build_gold(carts, products, created, whole_carts=w) for w in (False, True))
    for name in ("sales_daily", "user_ltv"):
        assert plan(apart[name]).count("Exchange hash") == 2
        assert plan(whole[name]).count("Exchange hash") == 1
    for name in apart:
        assert rows(whole[name]) == rows(apart[name]), name


def test_a_cart_of_two_days_is_one_order_of_its_user(spark, bronze, tmp_path):
    raw = {t: spark.read.schema(s).json(f"{bronze}/{t}/*/*/*") for t, s in RAW_SCHEMAS.items()}
    moved = raw | {"carts": raw["carts"].withColumn("date", F.lit("2021-01-01T00:00:00.000Z"))}
    lake = str(tmp_path / "lake")
    for day, tables in (("2024-01-05", raw), ("2024-01-06", moved)):
        paths = plans.run_pipeline(spark, tables, lake, day, snapshot="all")
    orders = {r["user_id"]: r["total_orders"] for r in spark.read.parquet(paths["user_ltv"]).collect()}
    assert orders == {1: 2, 2: 2}
