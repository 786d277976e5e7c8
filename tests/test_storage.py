import datetime as dt
import glob
import gzip
import os
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stratalode import sinks, sources
from stratalode.sinks import tables as sink_tables
from stratalode.sources.tables import jdbc_read_options


def days(spark, *dates):
    return spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "id int, at string").select(
        "id", F.col("at").cast("timestamp").alias("at")
    )


def test_json_lines_arrays_and_predicate(spark, tmp_path, rows):
    lines, array, pretty = tmp_path / "l.json", tmp_path / "a.json", tmp_path / "p.json"
    lines.write_text('{"id": 1}\n{"id": 2}\n')
    array.write_text('[{"id": 1}, {"id": 2}]')
    pretty.write_text('[\n {"id": 1},\n {"id": 2}\n]')
    for path in (lines, array):
        assert rows(sources.scan_json(spark, str(path), "id > 1")) == [(2,)]
    assert sources.scan_json(spark, str(pretty), multi_line=True).count() == 2
    typed = sources.scan_json(spark, str(lines), schema="id int, more string")
    assert typed.dtypes == [("id", "int"), ("more", "string")]
    with pytest.raises(AnalysisException):
        sources.scan_json(spark, str(tmp_path / "none"))


def test_json_string_list(spark, tmp_path, rows):
    one, spread = tmp_path / "one.json", tmp_path / "spread.json"
    one.write_text('["b", "a"]')
    spread.write_text('[\n"b",\n"a"]')
    assert rows(sources.scan_json_string_list(spark, str(one), "category")) == [("a",), ("b",)]
    listed = sources.scan_json_string_list(spark, str(spread), "category", multi_line=True)
    assert rows(listed) == [("a",), ("b",)]


def test_parquet_fallbacks_and_errors(spark, tmp_path):
    folder = str(tmp_path / "zone")
    spark.range(3).write.parquet(f"{folder}/t.parquet")
    assert sources.scan_parquet(spark, folder, table="t").count() == 3
    assert sources.scan_parquet(spark, folder + "/", table="t").count() == 3
    assert sources.scan_parquet(spark, f"{folder}/t.parquet", table="other", predicate="id = 1").count() == 1
    with pytest.raises(AnalysisException):
        sources.scan_parquet(spark, str(tmp_path / "none"), table="t")
    with pytest.raises(AnalysisException):
        sources.scan_parquet(spark, folder, table="t", predicate="no_such_column = 1")
    empty = sources.scan_parquet(spark, str(tmp_path / "none"), allow_missing=True, schema="id int")
    assert empty.dtypes == [("id", "int")] and empty.isEmpty()
    with pytest.raises(ValueError):
        sources.scan_parquet(spark, folder, allow_missing=True)


def test_parquet_schemas_are_merged(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1).write.parquet(path)
    spark.range(1).withColumn("more", F.lit("x")).write.mode("append").parquet(path)
    assert sources.scan_parquet(spark, path).columns == ["id", "more"]


def test_sort_and_limit(spark, plan):
    df = spark.range(100).repartition(4)
    assert [r[0] for r in sources.source_sort_limit(df, limit=2).collect()] == [0, 1]
    top = sources.source_sort_limit(df, sort="desc", limit=2)
    assert [r[0] for r in top.collect()] == [99, 98]
    assert "TakeOrdered" in plan(top)
    assert sources.source_sort_limit(df).count() == 100
    with pytest.raises(ValueError):
        sources.source_sort_limit(df, sort="down")


@pytest.mark.parametrize(
    ("last", "current", "expected"),
    [
        ("2023-11-05", "2024-02-01", "year BETWEEN 2023 AND 2024"),
        ("2024-01-05", "2024-03-01", "year = 2024 AND month BETWEEN 1 AND 3"),
        ("2024-01-05", "2024-01-09", "year = 2024 AND month = 1 AND day BETWEEN 5 AND 9"),
        ("2024-01-05", dt.date(2024, 1, 5), "year = 2024 AND month = 1 AND day = 5"),
    ],
)
def test_date_range_predicate(last, current, expected):
    assert sources.date_range_predicate(last, current) == expected


def test_date_range_prunes_partitions(spark, tmp_path, rows, plan):
    root = str(tmp_path)
    df = days(spark, "2023-12-31", "2024-01-01", "2024-01-02", "2024-02-01")
    assert sinks.write_silver_parquet(df, root, "t", date_column="at")
    assert os.path.isdir(f"{root}/t/year=2024/month=01/day=02")

    def ids(**options):
        scan = sources.scan_date_range(spark, f"{root}/t", "2023-12-31", "2024-01-01", **options)
        text = plan(scan)
        assert "PartitionFilters: [isnotnull" in text or "PartitionFilters: [(make_date" in text, text
        return [r[0] for r in rows(scan.select("id"))]

    assert ids() == [0, 1, 2, 3]
    assert ids(exact=True) == [0, 1]


def test_root_snapshots(spark, tmp_path, rows):
    root = str(tmp_path)
    for day, data in [("2024-01-31", [(1, "a")]), ("2024-02-01", [(1, "b"), (2, "b")])]:
        sinks.write_silver_parquet(spark.createDataFrame(data, "id int, v string"), root, "t", day)
    read = sources.scan_partitioned_root
    assert rows(read(spark, f"{root}/t")) == [
        (1, "a", 2024, 1, 31), (1, "b", 2024, 2, 1), (2, "b", 2024, 2, 1),
    ]
    assert rows(read(spark, f"{root}/t", "latest").select("id", "v")) == [(1, "b"), (2, "b")]
    assert rows(read(spark, f"{root}/t", "latest", before="2024-02-01").select("id", "v")) == [(1, "a")]
    assert read(spark, f"{root}/t", "latest", before="2024-01-31").isEmpty()
    assert read(spark, f"{root}/t", before="2024-02-01").count() == 1
    with pytest.raises(ValueError):
        read(spark, f"{root}/t", "newest")


def test_execution_date_reads_one_folder(spark, tmp_path, rows):
    root = str(tmp_path)
    sinks.land_bronze_json(spark.range(2), root, "t", "2024-01-05")
    sinks.land_bronze_json(spark.range(5), root, "t", "2024-01-06")
    sinks.land_bronze_json(spark.range(1), root, "today")
    one = sources.scan_execution_date(spark, root, "t", "2024-01-05")
    assert rows(one) == [(0, 2024, 1, 5), (1, 2024, 1, 5)]
    assert sources.scan_execution_date(spark, root + "/", "today").count() == 1
    with pytest.raises(AnalysisException):
        sources.scan_execution_date(spark, root, "t", "2024-01-07")
    with pytest.raises(ValueError):
        sources.scan_execution_date(spark, root, "t", "2024-01-05", fmt="csv")


def test_rerunning_a_day_replaces_only_that_day(spark, tmp_path):
    root = str(tmp_path)
    df = days(spark, "2024-01-01", "2024-01-02", "2024-01-02")
    sinks.write_silver_parquet(df, root, "t", date_column="at")
    sinks.write_silver_parquet(df.filter("id = 1"), root, "t", date_column="at")
    by_day = spark.read.parquet(f"{root}/t").groupBy("day").count().collect()
    assert {tuple(r) for r in by_day} == {(1, 1), (2, 1)}
    sinks.write_silver_parquet(spark.range(3), root, "u", "2024-01-01")
    sinks.write_silver_parquet(spark.range(2), root, "u", "2024-01-01")
    assert spark.read.parquet(f"{root}/u").count() == 2


def test_spread_days_are_gathered_before_writing(spark, tmp_path):
    df = days(spark, *[f"2024-01-{d:02d}" for d in range(1, 11)] * 20).repartition(4)
    sinks.land_bronze_json(df, str(tmp_path), "t", date_column="at")
    files = glob.glob(f"{tmp_path}/t/*/*/*/*.json")
    assert len(files) == 10


def test_null_fields_are_landed(spark, tmp_path):
    df = spark.range(1).withColumn("image", F.lit(None).cast("string"))
    sinks.land_bronze_json(df, str(tmp_path), "t", "2024-01-01")
    back = sources.scan_execution_date(spark, str(tmp_path), "t", "2024-01-01")
    assert back.columns[:2] == ["id", "image"]


def test_empty_frames_write_nothing(spark, tmp_path):
    root = str(tmp_path)
    assert not sinks.write_silver_parquet(spark.range(0), root, "t", "2024-01-01")
    assert not os.path.exists(f"{root}/t")
    assert sinks.write_silver_parquet(spark.range(0), root, "t", "2024-01-01", skip_empty=False)
    assert not sinks.write_table(spark.range(0), f"{root}/table")
    assert not os.path.exists(f"{root}/table")


def test_gold_parquet(spark, tmp_path):
    path = str(tmp_path / "gold")
    df = spark.range(6).withColumn("part", F.col("id") % 2)
    sinks.write_gold_parquet(df, path)
    sinks.write_gold_parquet(df, path, ["part"])
    assert sorted(p for p in os.listdir(path) if "=" in p) == ["part=0", "part=1"]
    assert spark.read.parquet(path).count() == 6


def test_merge_snapshot_never_touches_what_it_reads(spark, tmp_path, rows):
    root = str(tmp_path)
    first = spark.createDataFrame([(1, "a"), (2, "a")], "id int, v string")
    second = spark.createDataFrame([(2, "b"), (3, "b")], "id int, v string")
    for _ in range(2):
        merged = sinks.merge_snapshot(spark, first, root, "t", "2024-01-01")
        assert rows(merged) == [(1, "a"), (2, "a")]
    for _ in range(2):
        merged = sinks.merge_snapshot(spark, second, root, "t", "2024-01-03")
        assert rows(merged) == [(1, "a"), (2, "b"), (3, "b")]
    assert rows(sources.scan_partitioned_root(spark, f"{root}/t").filter("day = 1").select("id", "v")) == [
        (1, "a"), (2, "a"),
    ]


def test_table_locations():
    assert sinks.table_location("/r/", "t") == "/r/t"
    assert sinks.table_location("/r", "t", "d") == "/r/d/t"
    assert sinks.table_location("/r", "t", "d", "s") == "/r/d/s/t"
    assert sinks.table_location("/r", "t", "", "s") == "/r/t"


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_table_by_location(spark, tmp_path, rows, fmt):
    location = str(tmp_path / "t")
    feed = spark.createDataFrame(
        [(1, None, "r"), (2, 9, "r")], "id int, _ab_cdc_deleted_at int, _airbyte_raw string"
    )
    assert not sources.table_exists(spark, location, fmt)
    assert sinks.write_table(feed, location, fmt=fmt) is False
    assert sinks.write_table(feed, location, fmt=fmt) is True
    assert rows(sources.scan_table(spark, location, fmt)) == [(1,), (1,)]
    sinks.write_table(feed, location, "overwrite", fmt)
    assert rows(sources.scan_table(spark, location, fmt, "id = 1")) == [(1,)]
    with pytest.raises(ValueError):
        sinks.write_table(feed, location, "upsert")


def test_table_by_name(spark, rows):
    spark.sql("DROP TABLE IF EXISTS named_table")
    assert not sources.table_exists(spark, "named_table")
    sinks.write_table(spark.range(2), "named_table")
    sinks.write_table(spark.range(1), "named_table")
    assert rows(sources.scan_table(spark, "named_table")) == [(0,), (0,), (1,)]
    spark.sql("DROP TABLE named_table")


def test_relational_projection(spark):
    df = spark.sql("""
        SELECT 1 AS i, 2L AS l, 1.5D AS d, true AS b, 's' AS s, DATE'2024-01-02' AS dd,
               TIMESTAMP'2024-01-02 03:04:05.5' AS ts, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS ntz,
               array(1, NULL) AS a, named_struct('x', 1) AS st, map('k', 1) AS m,
               CAST(1.50 AS DECIMAL(5,2)) AS dec, CAST(NULL AS BOOLEAN) AS nb""")
    out = sinks.relational_projection(df)
    assert {t for _, t in out.dtypes} == {"int", "bigint", "double", "string"}
    assert tuple(out.first()) == (
        1, 2, 1.5, 1, "s", "2024-01-02", "2024-01-02 03:04:05.5", "2024-01-02 03:04:05",
        "[1,null]", '{"x":1}', '{"k":1}', "1.50", None,
    )


def test_jdbc_options():
    plain = jdbc_read_options("jdbc:x", "t")
    assert plain == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000"}
    split = jdbc_read_options("jdbc:x", "t", "id", (0, 100), 8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"]) == ("id", "0", "100")
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x", "t", "id")
    written = sink_tables.jdbc_write_options("jdbc:x", "t", 500, 4, True)
    assert written == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": "500", "truncate": "true", "numPartitions": "4",
    }


def test_jdbc_merge_stages_before_replacing(spark, tmp_path, monkeypatch, rows):
    """The database is stood in for by a Parquet file, as no database is available."""
    table = str(tmp_path / "db")
    spark.createDataFrame([(1, "a", 1), (2, "a", 0)], "id int, v string, flag int").write.parquet(table)
    monkeypatch.setattr(sink_tables, "scan_jdbc", lambda s, url, t, properties=None: s.read.parquet(t))
    monkeypatch.setattr(
        sink_tables, "write_jdbc", lambda df, url, t, properties=None: df.write.mode("overwrite").parquet(t)
    )
    incoming = spark.createDataFrame(
        [(2, "b", True, None), (3, "b", False, None), (1, "x", True, 5)],
        "id int, v string, flag boolean, _ab_cdc_deleted_at int",
    )
    sink_tables.merge_jdbc(incoming, "jdbc:x", table, "id")
    assert rows(spark.read.parquet(table)) == [(1, "a", 1), (2, "b", 1), (3, "b", 0)]


def test_staged_results_are_files_of_known_size(spark):
    staged = sinks.stage(spark.range(10), "numbers")
    assert staged.count() == 10
    assert len(staged.inputFiles()) > 0


def test_staging_leaves_nothing_and_changes_no_setting(spark, rows):
    before = spark.sparkContext.getCheckpointDir()
    with sinks.staging(spark) as stage:
        staged = stage(spark.range(3), "numbers")
        folder = Path(staged.inputFiles()[0].removeprefix("file:")).parent
        assert rows(staged) == [(0,), (1,), (2,)]
        assert folder.is_dir()
    assert not folder.exists()
    assert spark.sparkContext.getCheckpointDir() == before


def test_latest_day_and_ranges_open_no_other_day(spark, tmp_path, rows):
    root = str(tmp_path)
    for day in ("2023-12-31", "2024-01-30", "2024-02-01", "2024-03-01"):
        sinks.write_silver_parquet(days(spark, day), root, "t", day)
    for day in ("year=2023/month=12/day=31", "year=2024/month=01/day=30"):
        for file in Path(root, "t", day).glob("*.parquet"):
            file.write_bytes(b"no parquet")
    read = sources.scan_partitioned_root
    assert rows(read(spark, f"{root}/t", "latest").select("month")) == [(3,)]
    assert rows(read(spark, f"{root}/t", "latest", before="2024-03-01").select("month")) == [(2,)]
    assert sources.latest_partition(spark, f"{root}/t", "2024-01-30")[0] == dt.date(2023, 12, 31)
    assert sources.latest_partition(spark, f"{root}/t", "2023-12-31") is None
    scan = sources.scan_date_range
    assert rows(scan(spark, f"{root}/t", "2024-02-01", "2024-03-05").select("month")) == [(2,), (3,)]
    assert rows(scan(spark, f"{root}/t", "2024-01-31", "2024-02-28", exact=True).select("month")) == [(2,)]
    assert scan(spark, f"{root}/t", "2020-01-01", "2020-02-01").count() == 0


def test_business_columns_called_like_date_parts_are_not_replaced(spark, tmp_path):
    df = days(spark, "2024-01-01").withColumn("day", F.lit(5))
    with pytest.raises(ValueError, match="day"):
        sinks.write_silver_parquet(df, str(tmp_path), "t", date_column="at")


def test_merge_snapshot_keeps_recency_and_takes_deletions(spark, tmp_path, rows):
    root, by = str(tmp_path), "_airbyte_extracted_at"
    schema = f"id int, v string, {by} int"
    stored = spark.createDataFrame([(1, "a", 5), (1, "older", 4), (2, "a", 5)], schema)
    sinks.write_silver_parquet(stored, root, "t", "2024-01-01")
    late = spark.createDataFrame([(1, "late", 3), (2, "new", 6)], schema)
    merged = sinks.merge_snapshot(spark, late, root, "t", "2024-01-02", order_by=by)
    assert rows(merged) == [(1, "a", 5), (2, "new", 6)]
    feed = spark.createDataFrame([(1, "x", 7, 7), (3, "x", 7, None)], f"{schema}, _ab_cdc_deleted_at int")
    merged = sinks.merge_snapshot(spark, feed, root, "t", "2024-01-03", order_by=by, how="upsert")
    assert rows(merged) == [(2, "new", 6), (3, "x", 7)]
    first = sinks.merge_snapshot(spark, feed, root, "u", "2024-01-03", order_by=by, how="upsert")
    assert rows(first) == [(3, "x", 7)]


def test_appending_a_day_again_replaces_it(spark, tmp_path, rows):
    target = str(tmp_path / "table")
    for n, day in ((2, "2024-01-01"), (3, "2024-01-02"), (2, "2024-01-02")):
        sinks.write_table(spark.range(n), target, fmt="orc", execution_date=day)
    assert rows(sources.scan_table(spark, target, "orc").select("id", "day")) == [(0, 1), (0, 2), (1, 1), (1, 2)]


def test_single_files_and_day_folders_as_sources(spark, tmp_path, rows):
    root = str(tmp_path)
    spark.range(2).write.json(f"{root}/shop_carts.json")
    spark.range(3).write.parquet(f"{root}/carts.parquet")
    sinks.land_bronze_json(spark.range(1), root, "t", "2024-01-05")
    read = sources.scan_execution_date
    assert read(spark, f"{root}/shop_", "carts").count() == 2
    assert read(spark, f"{root}/shop_carts.json").count() == 2
    assert read(spark, f"{root}/carts.parquet").count() == 3
    assert rows(read(spark, f"{root}/t/year=2024/month=01/day=05").select("id", "day")) == [(0, 5)]


def test_a_named_table_in_a_days_own_folder(spark, tmp_path):
    folder = tmp_path / "year=2024/month=05/day=01"
    folder.mkdir(parents=True)
    (folder / "orders.json").write_text('{"id": 7}')
    for root in (str(folder), f"{folder}/"):
        assert [r["id"] for r in sources.scan_execution_date(spark, root, "orders", "2024-05-01").collect()] == [7]


def test_compressed_json_is_cut_by_records(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr("stratalode.sinks.files.RECORDS_PER_COMPRESSED_FILE", 400)
    df = spark.range(1000).withColumn("none", F.lit(None).cast("string")).coalesce(1)
    for name, codec in (("plain", None), ("zipped", "gzip")):
        sinks.land_bronze_json(df, str(tmp_path), name, "2024-06-01", compression=codec)
        landed = sources.scan_execution_date(spark, str(tmp_path), name, "2024-06-01", schema="id bigint, none string")
        assert rows(landed.select("id", "none")) == rows(df)
    assert len(glob.glob(f"{tmp_path}/plain/*/*/*/*.json")) == 1
    assert len(glob.glob(f"{tmp_path}/zipped/*/*/*/*.json.gz")) == 3


def test_landed_json_is_compressed_at_the_quickest_level(spark, tmp_path):
    df = spark.range(20_000).withColumn("text", F.sha1(F.col("id").cast("string"))).coalesce(1)
    sinks.land_bronze_json(df, str(tmp_path), "t", "2024-06-01", compression="gzip")
    (landed,) = Path(tmp_path).glob("t/*/*/*/*.json.gz")
    text = gzip.decompress(landed.read_bytes())
    assert text.count(b"\n") == 20_000
    sizes = {level: len(gzip.compress(text, level)) for level in (1, 6)}
    assert abs(landed.stat().st_size - sizes[1]) < abs(landed.stat().st_size - sizes[6])
