import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalode import operators as ops
from stratalode import sinks, sources
from stratalode.sources.evolution import note_schema, widen, widest_type


def widest(a, b):
    return widest_type(T.DataType.fromDDL(a), T.DataType.fromDDL(b)).simpleString()


@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [
        ("tinyint", "smallint", "smallint"), ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("float", "int", "double"),
        ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(38,10)", "bigint", "decimal(38,10)"), ("decimal(38,38)", "int", "double"),
        ("decimal(9,1)", "float", "double"), ("date", "timestamp", "timestamp"), ("date", "int", "string"), ("boolean", "int", "string"),
        ("string", "array<int>", "string"), ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,double>", "map<string,double>"),
        ("map<int,int>", "map<string,int>", "string"), ("struct<a:int>", "struct<A:bigint,b:date>", "struct<a:bigint,b:date>"),
    ],
)
def test_widest_types_in_both_orders(spark, a, b, expected):
    assert widest(a, b) == expected
    assert widest(b, a).lower() == expected
    assert widest(a, a) == T.DataType.fromDDL(a).simpleString()


def test_values_survive_widening_at_every_depth(spark, rows):
    old = spark.createDataFrame(
        [(1, [(1,), None], {"k": 1}, None), (None, None, None, (5, None))],
        "a int, items array<struct<n: int>>, m map<string, int>, s struct<x: int, y: string>",
    )
    new = T.StructType.fromDDL("more string, A bigint, items array<struct<n: string, extra: int>>, m map<string, double>, s string")
    got = widen(old, new)
    assert got.schema.simpleString() == new.simpleString()
    first, second = got.orderBy(F.col("A").desc_nulls_last()).collect()
    assert first == (None, 1, [("1", None), None], {"k": 1.0}, None)
    assert second == (None, None, None, None, '{"x":5}')


def days_of(spark, root, *frames, declare=True):
    for i, df in enumerate(frames):
        sinks.write_silver_parquet(df, root, "t", f"2024-06-0{i + 1}", declare=declare)
    return f"{root}/t"


def test_days_of_other_types_are_one_table(spark, tmp_path, rows, plan):
    three = (
        spark.sql("SELECT 1 AS id, 7 AS v"),
        spark.sql("SELECT 9007199254740993 AS ID, 2.5D AS v, 'x' AS w"),
        spark.sql("SELECT 3 AS id, 'text' AS v, 'y' AS w, named_struct('a', 1) AS s"),
    )
    with_notes = days_of(spark, str(tmp_path / "noted"), *three)
    got = sources.scan_evolving(spark, with_notes)
    assert got.columns == ["id", "v", "w", "s", "year", "month", "day"]
    assert rows(got.select("id", "v", "w", "s.a", "day")) == sorted(
        [(1, "7", None, None, 1), (9007199254740993, "2.5", "x", None, 2), (3, "text", "y", 1, 3)], key=repr
    )
    without = days_of(spark, str(tmp_path / "plain"), *three, declare=False)
    assert sources.noted_schemas(spark, without) == {}
    assert rows(sources.scan_evolving(spark, without)) == rows(got)
    assert rows(sources.scan_evolving(spark, with_notes, "2024-06-01", "2024-06-02").select("v")) == [(2.5,), (7.0,)]
    only = sources.scan_evolving(spark, with_notes).where("day = 2 AND w = 'x'")
    assert only.count() == 1 and "PushedFilters: [IsNotNull(w), EqualTo(w,x)]" in plan(only)
    with pytest.raises(ValueError, match="no finished day"):
        sources.scan_evolving(spark, str(tmp_path / "none"))


def test_a_plan_grows_with_schemas_and_not_with_days(spark, tmp_path, plan):
    root = str(tmp_path)
    days_of(spark, root, *[spark.sql(f"SELECT {i} AS id" if i % 2 else f"SELECT {i}L AS id") for i in range(6)])
    got = sources.scan_evolving(spark, f"{root}/t")
    assert plan(got).count("FileScan parquet") == 2 and got.count() == 6


def test_notes_never_speak_of_other_files(spark, tmp_path, rows):
    root = str(tmp_path)
    path = days_of(spark, root, spark.sql("SELECT 1 AS id"), spark.sql("SELECT 2 AS id"))
    sinks.write_silver_parquet(spark.sql("SELECT 'a' AS id"), root, "t", "2024-06-02")
    assert list(map(str, sources.noted_schemas(spark, path))) == ["2024-06-01"]
    assert rows(sources.scan_evolving(spark, path).select("id")) == [("1",), ("a",)]
    spread = spark.sql("SELECT 1.5D AS id, timestamp'2024-06-01 10:00:00' AS at")
    sinks.write_silver_parquet(spread, root, "t", date_column="at")
    assert sources.noted_schemas(spark, path) == {}
    assert rows(sources.scan_evolving(spark, path).select("id")) == [("1.5",), ("a",)]
    with pytest.raises(ValueError):
        sinks.write_silver_parquet(spread, root, "t", date_column="at", declare=True)
    note_schema(spark, path, "2024-06-02", T.StructType.fromDDL("year int"))
    with pytest.raises(ValueError, match="clash"):
        sources.scan_evolving(spark, path)


def scanned_rows(df):
    """Rows that a filtered scan hands on, after skipping row groups."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_clustered_writes_let_readers_skip(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr("stratalode.operators.sizing.TARGET_FILE_BYTES", 40_000)
    n = 40_000
    df = spark.range(n).select(F.expr("id * 7919 % 40000").alias("k"), F.col("id").alias("v")).repartition(4)
    staged = str(tmp_path / "in")
    df.write.parquet(staged)
    df = spark.read.parquet(staged)
    shares = {}
    for name, by in (("plain", None), ("clustered", "k")):
        sinks.write_silver_parquet(df, str(tmp_path), name, "2024-06-01", cluster_by=by)
        back = spark.read.parquet(f"{tmp_path}/{name}/year=2024/month=06/day=01")
        assert rows(back) == rows(df)
        shares[name] = scanned_rows(back.where("k = 12345")) / n
    assert shares["plain"] == 1 and shares["clustered"] <= 0.2
    gold = str(tmp_path / "gold")
    sinks.write_gold_parquet(df.withColumn("p", F.col("k") % 2), gold, "p", cluster_by="k")
    back = spark.read.parquet(gold)
    assert rows(back.select("k", "v")) == rows(df)
    assert scanned_rows(back.where("p = 1 AND k = 12345")) <= 0.2 * n
    sinks.write_silver_parquet(
        df.withColumn("at", F.expr("timestamp'2024-06-01 00:00:00' + make_interval(0, 0, 0, v % 2)")), str(tmp_path), "spread", date_column="at", cluster_by="k"
    )
    back = spark.read.parquet(f"{tmp_path}/spread")
    assert back.count() == n and scanned_rows(back.where("day = 1 AND k = 12345")) <= 0.2 * n


def test_a_hot_value_fills_several_ranges(spark):
    hot = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.lit(None)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    parts = ops.cluster_rows(hot, "k", partitions=9).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 9 and max(r["count"] for r in parts) < 2000


def test_ranges_follow_the_rows_and_not_the_stored_bytes(spark, tmp_path):
    """A million rows in few stored bytes are not sorted by one task."""
    path = str(tmp_path / "small")
    spark.range(1_000_000).select("id", F.lit(1.0).alias("k")).write.parquet(path)
    df = spark.read.parquet(path)
    assert ops.planned_bytes(df) < 10_000_000
    sinks.write_silver_parquet(df, str(tmp_path), "clustered", "2024-06-01", cluster_by="k")
    back = spark.read.parquet(f"{tmp_path}/clustered/year=2024/month=06/day=01")
    sizes = [r["count"] for r in back.groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == 1_000_000 and max(sizes) < 500_000


def test_sizes_without_reading_columns(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("text", F.repeat(F.lit("x"), 50)).repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    sized = ops.estimate_stored_size(df)
    assert "ReadSchema: struct<>" in plan(sized)
    rows, files, size, partitions = sized.first()
    assert (rows, files, partitions) == (1000, len(glob.glob(f"{path}/*.parquet")), 1)
    assert ops.planned_bytes(df) == size > 0
    assert ops.planned_bytes(df.join(df.withColumnRenamed("text", "more"), "id")) <= 2 * size
    assert ops.planned_bytes(spark.createDataFrame([(1,)], "a int")) is None
    empty = ops.estimate_stored_size(df.where("false")).first()
    assert empty[:3] == (0, 0, 0)
