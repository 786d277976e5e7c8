import pytest

from stratalode.operators import (
    drop_cdc_columns,
    drop_columns,
    drop_ingestion_columns,
    rename_redundant_tokens,
    select_columns,
    split_pii,
    strip_prefix,
    with_expression,
    with_expressions,
)


def frame(spark, *names):
    return spark.createDataFrame([tuple(range(len(names)))], list(names))


def test_select_and_drop(spark):
    df = frame(spark, "a", "b", "c")
    assert select_columns(df, ["c", "a"]).columns == ["c", "a"]
    assert drop_columns(df, ["b", "absent"]).columns == ["a", "c"]


def test_technical_columns(spark):
    df = frame(spark, "id", "_airbyte_raw_id", "_ab_cdc_cursor", "year", "month", "day", "yearly")
    assert drop_ingestion_columns(df).columns == ["id", "_ab_cdc_cursor", "yearly"]
    assert drop_cdc_columns(df).columns == ["id", "_airbyte_raw_id", "year", "month", "day", "yearly"]


def test_strip_prefix_removes_every_occurrence_of_leading_names(spark):
    df = frame(spark, "x_a", "x_b_x_c", "a_x_d")
    assert strip_prefix(df, "x_").columns == ["a", "b_c", "a_x_d"]


@pytest.mark.parametrize("names", [("x_a", "a"), ("x_", "b")])
def test_strip_prefix_refuses_clashes_and_empty_names(spark, names):
    with pytest.raises(ValueError):
        strip_prefix(frame(spark, *names), "x_")


def test_redundant_tokens_keep_the_last_and_never_clash(spark):
    df = frame(spark, "address_city_address", "a_a", "a", "plain", "__v", "b_b", "b_b_b")
    assert rename_redundant_tokens(df).columns == [
        "city_address", "a_a", "a", "plain", "_v", "b", "b_b_b",
    ]


def test_expressions_replace_existing_columns_only(spark, rows):
    df = frame(spark, "a", "b")
    changed = with_expressions(df, {"a": "a + 10", "b": "a + b", "c": "1"})
    assert changed.columns == ["a", "b"]
    assert rows(changed) == [(10, 11)]


def test_expression_adds_a_column_and_may_be_empty(spark, rows):
    df = frame(spark, "a")
    assert rows(with_expression(df, "b", "a + 1")) == [(0, 1)]
    assert with_expression(df, "b") is df


def test_split_pii(spark):
    df = frame(spark, "id", "Name", "city")
    catalog = {
        "columns_description": [
            {"column": "id", "classification": "PII"},
            {"column": "name", "classification": "PII"},
            {"column": "city"},
            {"column": "gone", "classification": "PII"},
        ]
    }
    public, personal = split_pii(df, catalog, "id")
    assert public.columns == ["id", "city"]
    assert personal.columns == ["id", "Name"]
