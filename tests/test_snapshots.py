"""Snapshots in buckets, and deleted keys that stay deleted."""

import random
import re

import pytest
from pyspark.sql import functions as F

from stratalode import operators as ops
from stratalode import sinks

FEED = "id bigint, v string, updated_at bigint, _ab_cdc_deleted_at bigint"


def feed_of(rng, n=25):
    rows = []
    for _ in range(n):
        at = rng.randrange(1, 60)
        rows.append((rng.choice([None, *range(30)]), f"v{rng.randrange(99)}", at, at if rng.random() < 0.3 else None))
    return rows


def by_hand(days, tombstones):
    """Rows per key after each day's feed, change by change: {key: (recency, row)}."""
    stored, gone, keyless = {}, {}, []
    for feed in days:
        newest = {}
        for row in feed:
            if row[0] is None:
                if row[3] is None:
                    keyless.append((None, row[1], row[2]))
            else:
                rank = (row[2], row[3] is not None, row[3] or -1, row[1])
                if row[0] not in newest or rank > newest[row[0]][0]:
                    newest[row[0]] = (rank, row)
        for key, (_, row) in newest.items():
            if tombstones and key in gone and row[2] <= gone[key]:
                continue
            if key in stored and stored[key][0] > row[2]:
                continue
            stored.pop(key, None)
            gone.pop(key, None)
            if row[3] is not None:
                gone[key] = row[2]
            else:
                stored[key] = (row[2], (key, row[1], row[2]))
    return sorted([r for _, r in stored.values()] + keyless, key=repr)


@pytest.mark.parametrize("tombstones", [None, 100])
@pytest.mark.parametrize("buckets", [None, 3])
def test_merges_of_many_days_agree_with_change_by_change(spark, rows, tmp_path, buckets, tombstones):
    rng = random.Random(8)
    # Of changes with equal recency the deletion wins here; ties of live ones go by their values.
    days = [feed_of(rng) for _ in range(4)]
    days = [[r for r in day if sum(q[0] == r[0] and q[2] == r[2] for q in day) == 1 or r[0] is None] for day in days]
    for n, feed in enumerate(days):
        merged = sinks.merge_snapshot(
            spark, spark.createDataFrame(feed, FEED), str(tmp_path), "t", f"2024-05-0{n + 1}", "id",
            how="upsert", buckets=buckets, tombstone_days=tombstones,
        )
    assert rows(merged.select("id", "v", "updated_at")) == by_hand(days, tombstones)


def test_tombstones_go_after_their_days_and_need_recency(spark, rows, tmp_path):
    def day(number, *changes):
        frame = spark.createDataFrame(list(changes), FEED)
        merged = sinks.merge_snapshot(spark, frame, str(tmp_path), "t", f"2024-05-{number:02d}", "id", how="upsert", tombstone_days=3)
        return rows(merged.select("id", "v"))

    assert day(1, (1, "a", 5, None), (7, "never seen", 9, 9)) == [(1, "a")]
    assert day(2, (1, "a", 8, 8)) == []
    assert day(3, (1, "late", 6, None), (7, "late", 4, None)) == []
    assert day(3, (1, "tie", 8, None)) == []
    assert day(4, (7, "after three days", 4, None)) == [(7, "after three days")]
    assert day(9, (1, "forgotten", 6, None)) == [(1, "forgotten"), (7, "after three days")]
    assert day(10, (1, "x", 20, 20), (1, "y", 21, None)) == [(1, "y"), (7, "after three days")]
    with pytest.raises(ValueError, match="recency"):
        sinks.merge_snapshot(spark, spark.range(3), str(tmp_path), "u", "2024-05-01", "id", how="upsert", tombstone_days=3)
    with pytest.raises(ValueError, match="dedup"):
        sinks.merge_snapshot(spark, spark.range(3), str(tmp_path), "u", "2024-05-01", "id", tombstone_days=3)


def stored_and_incoming(spark, tmp_path, n=400):
    rows = [(i, f"k{i % 3}", i * 1.5, 1) for i in range(n)] + [(None, "k0", 7.0, 1)]
    schema = "`a b` bigint, `k``x` string, v double, updated_at bigint"
    path = str(tmp_path / "it's")
    sinks.write_bucketed(spark.createDataFrame(rows, schema).repartition(5), path, ["a b", "k`x"], 4)
    change = [(i, f"k{i % 3}", -1.0, i % 3, True) for i in range(n - 5, n + 5)] + [(None, "k0", 8.0, 2, True), (None, "k1", 9.0, 2, True)]
    return path, spark.createDataFrame(change, schema + ", extra boolean")


@pytest.mark.parametrize("broadcast", [-1, 10_000_000])
def test_stored_rows_are_not_shuffled(spark, rows, plan, tmp_path, broadcast):
    path, incoming = stored_and_incoming(spark, tmp_path)
    keys, before = ["a b", "k`x"], spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        merged = ops.merge_buckets(sinks.scan_bucketed(spark, path), incoming, keys, 4)
        text = plan(merged)
        want = ops.merge_dedup(spark.read.parquet(path), incoming, keys)
        assert rows(merged) == rows(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joined = text[: text.index("isnull(a b#")] if "isnull(a b#" in text else text
    assert "Bucketed: true" in text
    for part in re.split(r"\n(?=\s*[:+\s]*\+?- Exchange|\s*:?\s*\+- Exchange)", text):
        if "Exchange hashpartitioning" in part and "Bucketed: true" in part.split("SortMergeJoin")[0]:
            below = part.split("Exchange hashpartitioning", 1)[1]
            assert "FileScan" not in below.split("- Exchange")[0] or "IsNull" in below or "isnull" in below
    assert joined.count("Exchange hashpartitioning") <= 2


def test_merged_rows_are_written_one_file_per_bucket(spark, tmp_path):
    path, incoming = stored_and_incoming(spark, tmp_path)
    keys = ["a b", "k`x"]
    merged = ops.merge_buckets(sinks.scan_bucketed(spark, path), incoming, keys, 4).where("`a b` is not null")
    target = str(tmp_path / "next")
    sinks.write_bucketed(merged, target, keys, 4)
    files = [f.name for f in (tmp_path / "next").glob("part-*.parquet")]
    assert len(files) == len({re.search(r"_(\d{5})\.", f)[1] for f in files}) == 4
    assert sinks.scan_bucketed(spark, target).count() == 405
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_a_plain_snapshot_becomes_a_bucketed_one_and_back(spark, rows, tmp_path):
    root, schema = str(tmp_path), "id bigint, v string, updated_at bigint"

    def day(number, buckets, *changes):
        frame = spark.createDataFrame(list(changes), schema)
        return rows(sinks.merge_snapshot(spark, frame, root, "t", f"2024-05-{number:02d}", "id", buckets=buckets))

    assert day(1, None, (1, "a", 1), (2, "a", 1)) == [(1, "a", 1), (2, "a", 1)]
    assert day(2, 4, (2, "b", 2), (3, "b", 2)) == [(1, "a", 1), (2, "b", 2), (3, "b", 2)]
    assert day(3, 2, (2, "old", 0), (None, "n", 3)) == [(1, "a", 1), (2, "b", 2), (3, "b", 2), (None, "n", 3)]
    assert day(4, None, (3, "c", 4)) == [(1, "a", 1), (2, "b", 2), (3, "c", 4), (None, "n", 3)]


def test_upsert_keeps_columns_that_the_feed_lacks(spark, rows, tmp_path):
    stored = spark.createDataFrame([(1, "a", "own"), (2, "b", "own"), (None, "n", "own")], "id bigint, v string, mine string")
    sinks.write_bucketed(stored, str(tmp_path / "s"), ["id"], 2)
    change = spark.createDataFrame([(1, "z", True, None), (2, "z", True, 5), (3, "z", False, None), (4, "z", False, 5), (None, "q", True, None)],
                                   "ID bigint, v string, more boolean, _ab_cdc_deleted_at bigint")
    merged = ops.merge_buckets(sinks.scan_bucketed(spark, str(tmp_path / "s")), change, "id", 2, how="upsert")
    want = ops.merge_upsert(stored, change, "id", keep_recency=True)
    assert rows(merged.select("id", "v", "mine", "more")) == rows(want.select("id", "v", "mine", "more"))
    assert (3, "z", None, False) in rows(merged.select("id", "v", "mine", F.col("more")))
