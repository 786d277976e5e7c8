import random

import pytest
from pyspark.sql import functions as F

from stratalode.operators import dedup_latest, resolve_keys

CATALOG = {"columns_description": [{"column": "USERID", "primary_key": True}, {"column": "v"}]}


def test_key_resolution_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, userId int, _id int")
    assert resolve_keys(df, "userid") == ["userId"]
    assert resolve_keys(df, catalog=CATALOG) == ["userId"]
    assert resolve_keys(df, ["id", "userId"], CATALOG) == ["id", "userId"]
    assert resolve_keys(df, ["id", "gone"], CATALOG) == ["userId"]
    assert resolve_keys(df) == ["id"]
    assert resolve_keys(df.drop("id")) == ["_id"]
    assert resolve_keys(df.drop("userId"), catalog=CATALOG) == ["id"]
    with pytest.raises(ValueError, match="no key"):
        resolve_keys(df.select("userId"))


def brute_latest(data, key, order):
    best = {}
    for row in data:
        rank = tuple((row[i] is not None, row[i] if row[i] is not None else 0) for i in order)
        if key(row) not in best or rank > best[key(row)][0]:
            best[key(row)] = (rank, row)
    return sorted((row for _, row in best.values()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_latest_against_brute_force(spark, rows, seed):
    """A third of the rows share one key; recency has NULLs and ties; keys may be NULL."""
    rng = random.Random(seed)
    data = [
        (
            7 if rng.random() < 0.35 else rng.choice([None, *range(20)]),
            rng.choice([None, 1, 2, 3]),
            rng.choice([None, 1, 2]),
            i,
        )
        for i in range(400)
    ]
    df = spark.createDataFrame(data, "id int, updated_at int, __v int, payload int").repartition(7)
    expected = brute_latest(data, lambda r: r[0], [1, 2, 3])
    assert rows(dedup_latest(df)) == expected
    assert rows(dedup_latest(dedup_latest(df))) == expected


def test_ordering_columns_fall_back(spark, rows):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 4)], "id int, date int, other int")
    assert rows(dedup_latest(df)) == [(1, 2, 4)]
    assert rows(dedup_latest(df, order_by="other")) == [(1, 1, 5)]
    assert rows(dedup_latest(df, order_by=["absent"])) == [(1, 2, 4)]
    assert rows(dedup_latest(df.drop("date"))) == [(1, 5)]


def test_explicit_tie_break_and_columns_that_cannot_be_ordered(spark):
    df = spark.createDataFrame(
        [(1, 1, 5, {"a": 1}), (1, 1, 6, {"a": 2})], "id int, __v int, x int, m map<string, int>"
    )
    assert dedup_latest(df, tie_break=["x"]).first()["x"] == 6
    assert dedup_latest(df).first()["x"] == 6


def test_a_column_called_like_the_helper_survives(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "id int, _position int, rank string")
    assert rows(dedup_latest(df, order_by="_position")) == [(1, 2, "b")]


def test_rows_per_key_are_limited_before_the_shuffle(spark, plan):
    df = spark.range(1000).select((F.col("id") % 2).alias("id"), F.col("id").alias("__v"))
    text = plan(dedup_latest(df))
    # Plans print from the last step to the first.
    assert text.index("row_number(), 1, Final") < text.index("Exchange hashpartitioning")
    assert text.index("row_number(), 1, Partial") > text.index("Exchange hashpartitioning")
