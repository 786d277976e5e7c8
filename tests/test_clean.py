import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratalode.operators import (
    cast_timestamp_columns,
    fill_null_nested,
    filter_predicate,
    filter_soft_deleted,
    limit_string_length,
    nullify_sentinel_dates,
)


def test_predicate(spark, rows):
    df = spark.range(5)
    assert rows(filter_predicate(df, "id >= 3")) == [(3,), (4,)]
    assert filter_predicate(df, "") is df


def test_soft_deleted_rows_go_only_if_marked(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, _ab_cdc_deleted_at int")
    assert rows(filter_soft_deleted(df)) == [(1, None)]
    plain = spark.range(1)
    assert filter_soft_deleted(plain) is plain


@pytest.mark.parametrize("dtype", ["date", "timestamp", "timestamp_ntz"])
def test_sentinel_range_equals_the_text_rule(spark, dtype):
    texts = ["-0001-12-31", "0000-01-01", "0000-12-31", "0001-01-01", "0001-01-31", "0001-02-01",
             "0002-01-01", "1999-01-01", "2024-02-29", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.col("t").cast(dtype).alias("v")
    )
    text = F.col("v").cast("string")
    by_text = F.when(text.rlike("^0000-|^0001-01-"), F.lit(None)).otherwise(text)
    got = [r[0] for r in nullify_sentinel_dates(df).select(text).collect()]
    assert got == [r[0] for r in df.select(by_text).collect()]


def test_sentinels_in_text_are_left_alone(spark, rows):
    df = spark.createDataFrame([("0001-01-01",)], "s string")
    assert nullify_sentinel_dates(df) is df


def test_timestamps_are_cast_by_type_or_name(spark):
    df = spark.createDataFrame(
        [("2024-01-02T03:04:05Z", "nonsense", "2024-01-02", 7, dt.date(2024, 1, 2))],
        "createdDate string, update_note string, title string, time_ms int, day_date date",
    ).withColumn("ntz", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"))
    cast = cast_timestamp_columns(df)
    assert dict(cast.dtypes) == {
        "createdDate": "timestamp", "update_note": "timestamp", "title": "string",
        "time_ms": "int", "day_date": "date", "ntz": "timestamp",
    }
    row = cast.select(F.col("createdDate").cast("string"), "update_note").first()
    assert tuple(row) == ("2024-01-02 03:04:05", None)
    assert dict(cast_timestamp_columns(df, only=["createdDate"]).dtypes)["update_note"] == "string"
    assert dict(cast_timestamp_columns(df, exclude="update_note").dtypes)["update_note"] == "string"


def test_strings_are_cut_at_any_depth_and_nulls_stay(spark):
    schema = """
        s string, a array<string>, st struct<x: string, n: int>, ast array<struct<`x.y`: string, n: int>>,
        aa array<array<string>>, m map<string, string>, n int"""
    df = spark.createDataFrame(
        [
            ("abcdef", ["abcd", None], ("abcd", 1), [("abcd", 2), None], [["abcd"], None], {"k": "abcd"}, 1),
            (None, None, None, None, None, None, None),
            ("äöüß", [], ("ä", None), [], [], {}, 2),
        ],
        schema,
    )
    cut = limit_string_length(df, limit=3)
    assert cut.schema.simpleString() == df.schema.simpleString()
    first, second, third = (r.asDict(recursive=True) for r in cut.collect())
    assert first == {
        "s": "abc", "a": ["abc", None], "st": {"x": "abc", "n": 1},
        "ast": [{"x.y": "abc", "n": 2}, None], "aa": [["abc"], None], "m": {"k": "abcd"}, "n": 1,
    }
    assert set(second.values()) == {None}
    assert third["s"] == "äöü" and third["st"] == {"x": "ä", "n": None}


def test_default_limit_counts_characters_and_columns_can_be_chosen(spark):
    df = spark.range(1).select(
        F.repeat(F.lit("é"), 32_001).alias("long"), F.repeat(F.lit("é"), 32_000).alias("fits")
    )
    assert limit_string_length(df).select(F.length("long"), F.length("fits")).first() == (32_000, 32_000)
    assert limit_string_length(df, "fits").select(F.length("long")).first()[0] == 32_001


def test_null_arrays_and_structs_are_filled_at_the_top_level_only(spark):
    df = spark.createDataFrame(
        [(None, None, None), ([1], (1, None), "x")],
        "a array<int>, s struct<i: int, inner: array<string>>, t string",
    )
    filled = fill_null_nested(df).collect()
    assert filled[0].asDict(recursive=True) == {"a": [], "s": {"i": None, "inner": None}, "t": None}
    assert filled[1].asDict(recursive=True) == {"a": [1], "s": {"i": 1, "inner": None}, "t": "x"}
    assert fill_null_nested(df, only="a").first()["s"] is None
    plain = spark.range(1)
    assert fill_null_nested(plain) is plain
