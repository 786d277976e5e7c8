import random

import pytest

from stratalode.operators import align_columns, merge_dedup, merge_upsert


def test_align_adds_missing_columns_ignoring_case(spark):
    target = spark.createDataFrame([(1, "a")], "id int, Name string")
    source = spark.createDataFrame([(1, "b", [1])], "id int, name string, extra array<int>")
    aligned = align_columns(target, source)
    assert aligned.dtypes == [("id", "int"), ("Name", "string"), ("extra", "array<int>")]
    assert aligned.first() == (1, "a", None)
    assert align_columns(target, target) is target


def brute_upsert(target, source):
    """target (k, a, kept); source (k, a, added, version, deleted).

    NULL keys never match: each such change is inserted unless it is a deletion.
    """
    changes = {}
    nulls = []
    for row in source:
        if row[0] is None:
            nulls += [(None, row[1], None, row[2])] if row[4] is None else []
            continue
        rank = (row[3], row[1], row[2], row[4] or 0)
        if row[0] not in changes or rank > changes[row[0]][0]:
            changes[row[0]] = (rank, row)
    out = []
    for k, a, kept in target:
        change = changes.get(k, (None, None))[1] if k is not None else None
        if change is None:
            out.append((k, a, kept, None))
        elif change[4] is None:
            out.append((k, change[1], kept, change[2]))
    known = {k for k, *_ in target if k is not None}
    for k, (_, change) in changes.items():
        if k not in known and change[4] is None:
            out.append((k, change[1], None, change[2]))
    return sorted(out + nulls, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_upsert_against_brute_force(spark, rows, seed):
    """One key fills a third of both sides; keys may be NULL; versions never tie."""
    rng = random.Random(seed)

    def key():
        return 3 if rng.random() < 0.33 else rng.choice([None, *range(15)])

    target = [(key(), rng.randint(0, 99), f"t{i}") for i in range(60)]
    source = [
        (key(), rng.randint(0, 99), f"s{i}", i, i if rng.random() < 0.4 else None) for i in range(80)
    ]
    t = spark.createDataFrame(target, "k int, a int, kept string").repartition(5)
    s = spark.createDataFrame(
        source, "k int, a int, added string, _ab_cdc_updated_at int, _ab_cdc_deleted_at int"
    ).repartition(5)
    merged = merge_upsert(t, s, "k")
    assert merged.columns == ["k", "a", "kept", "added"]
    assert rows(merged) == brute_upsert(target, source)


def test_upsert_is_idempotent_and_keeps_the_target_types(spark, rows):
    t = spark.createDataFrame([(1, 5), (2, 6)], "id bigint, v bigint")
    s = spark.createDataFrame([(2, 7), (3, 8)], "id int, v int")
    once = merge_upsert(t, s)
    assert once.dtypes == [("id", "bigint"), ("v", "bigint")]
    assert rows(once) == [(1, 5), (2, 7), (3, 8)]
    assert rows(merge_upsert(once, s)) == rows(once)


def test_small_feed_leaves_the_target_unshuffled(spark, plan):
    t = spark.range(1000).selectExpr("id", "id * 2 AS v")
    s = spark.range(2).selectExpr("id", "id AS v")
    text = plan(merge_upsert(t, s, "id"))
    update = text[: text.index("LeftAnti")]
    assert "LeftOuter, BuildRight" in update
    assert "Range" in update[update.index("LeftOuter") :].split("BroadcastExchange")[0]
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("unique", [False, True])
def test_merge_takes_the_newest_and_the_incoming_on_ties(spark, rows, unique):
    existing = spark.createDataFrame(
        [(1, "old", 5), (2, "old", 5), (3, "old", 9), (4, "old", None)],
        "id int, v string, updated_at int",
    )
    incoming = spark.createDataFrame(
        [(2, "new", 5, "x"), (3, "new", 8, "x"), (4, "new", None, "x"), (5, "new", 1, "x"), (5, "newer", 2, "x")],
        "id int, v string, updated_at int, extra string",
    )
    merged = merge_dedup(existing, incoming, existing_is_unique=unique)
    assert merged.columns == ["id", "v", "updated_at", "extra"]
    expected = [
        (1, "old", 5, None), (2, "new", 5, "x"), (3, "old", 9, None), (4, "new", None, "x"), (5, "newer", 2, "x"),
    ]
    assert rows(merged) == expected
    assert rows(merge_dedup(merged, incoming, existing_is_unique=unique)) == expected


def test_merge_without_recency_prefers_incoming_and_ignores_deleted(spark, rows):
    existing = spark.createDataFrame([(1, "z"), (2, "z")], "id int, v string")
    incoming = spark.createDataFrame(
        [(1, "a", None), (2, "a", 1), (3, "a", 1)], "id int, v string, _ab_cdc_deleted_at int"
    )
    assert rows(merge_dedup(existing, incoming).select("id", "v")) == [(1, "a"), (2, "z")]


def test_null_keys_merge_alike_either_way(spark, rows):
    existing = spark.createDataFrame([(None, 1, "a"), (1, None, "a"), (2, 2, "a")], "k int, l int, v string")
    incoming = spark.createDataFrame([(None, 1, "b"), (3, None, "b")], "k int, l int, v string")
    expected = [(1, None, "a"), (2, 2, "a"), (3, None, "b"), (None, 1, "b")]
    for unique in (False, True):
        assert rows(merge_dedup(existing, incoming, ["k", "l"], existing_is_unique=unique)) == expected


def test_merge_keeps_untouched_duplicates_only_when_told_they_are_unique(spark):
    existing = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    incoming = spark.createDataFrame([(2, "c")], "id int, v string")
    assert merge_dedup(existing, incoming).count() == 2
    assert merge_dedup(existing, incoming, existing_is_unique=True).count() == 3


def test_unique_merge_and_upsert_read_each_side_once(spark, tmp_path, plan):
    """One wide scan of the table and one of its keys; the feed once, as it is staged."""
    spark.range(50).selectExpr("id", "id AS v", "1 AS updated_at").write.parquet(f"{tmp_path}/t")
    spark.range(5).selectExpr("id", "id AS v", "2 AS updated_at").write.parquet(f"{tmp_path}/s")
    t, s = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")

    def schemas(df, folder):
        lines = [x for x in plan(df).splitlines() if "FileScan" in x and f"{tmp_path}/{folder}]" in x]
        return sorted(x.split("ReadSchema: ")[1] for x in lines)

    merged = merge_dedup(t, s, existing_is_unique=True)
    assert schemas(merged, "t") == ["struct<id:bigint,v:bigint,updated_at:int>", "struct<id:bigint>"]
    upserted = merge_upsert(t, s)
    assert schemas(upserted, "s") == []
    assert schemas(upserted, "t") == ["struct<id:bigint,v:bigint,updated_at:int>", "struct<id:bigint>"]


def test_upsert_with_recency_leaves_newer_rows_alone(spark, rows):
    t = spark.createDataFrame([(1, "t", 5), (2, "t", 5), (3, "t", 5), (4, "t", None)], "id int, v string, updated_at int")
    s = spark.createDataFrame(
        [(1, "s", 4, None), (2, "s", 6, None), (3, "s", 4, 4), (4, "s", 1, None)],
        "id int, v string, updated_at int, _ab_cdc_deleted_at int",
    )
    assert rows(merge_upsert(t, s, keep_recency=True)) == [(1, "t", 5), (2, "s", 6), (3, "t", 5), (4, "s", 1)]
