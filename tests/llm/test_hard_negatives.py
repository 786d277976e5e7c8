import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalode.llm import hard_negatives as hn

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_force(rows, asked, positives=5, negatives=3):
    """Every anchor against every row, in Python's whole numbers."""
    held = []
    for key, vector, label in rows:
        if key is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        if sum(x * x for x in whole) < 2**62:
            held.append((key, whole, label))
    out = []
    for key, whole, label in sorted({(k, tuple(v), n) for k, v, n in held if asked(k)}):
        scored = [(sum(x * y for x, y in zip(whole, v, strict=True)), k, n) for k, v, n in held if k != key and len(v) == len(whole)]
        best = sorted(((s, k) for s, k, n in scored if n == label), key=lambda r: (-r[0], r[1]))[:positives]
        for s, positive in best:
            fit = sorted(((t, k) for t, k, n in scored if n != label and 50 * s <= 100 * t <= 95 * s), key=lambda r: (-r[0], r[1]))
            out += [(key, positive, rank, k, s, t) for rank, (t, k) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def clustered(n, dims=12, seed=7):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dims))
    near = centres[rng.integers(0, 9, n)] + rng.normal(scale=0.4, size=(n, dims))
    scale = np.exp(rng.normal(scale=1.0, size=n))
    near[:: n // 11] = near[0]
    return [(i, [float(np.float32(x)) for x in v * s], int(i % 3 > 0) * (i % 7)) for i, (v, s) in enumerate(zip(near, scale, strict=True))]


def mined(spark, rows, every=50, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = hn.mine_hard_negatives(df, df.where(F.col("vec_id") % every == 0), **options)
    return sorted(tuple(r) for r in found.collect())


def test_results_agree_with_brute_force(spark):
    rows = clustered(1200)
    want = brute_force(rows, lambda k: k % 10 == 0)
    assert len(want) > 500
    assert mined(spark, rows, 10, block_rows=70, chunk_rows=9) == want
    assert mined(spark, rows, 10) == want


def test_odd_rows_agree_with_brute_force(spark):
    rng = random.Random(1)
    rows = clustered(200, 4)
    rows += [(1000 + i, [rng.choice([0.0, 0.5, -0.5]) for _ in range(4)], i % 2) for i in range(60)]  # ties and zero vectors
    rows += [(2000, None, 1), (2001, [1.0, None, 0.0, 0.0], 1), (2002, [NAN, 0.0, 0.0, 0.0], 1), (2003, [INF, 0.0, 0.0, 0.0], 1), (None, [1.0] * 4, 1)]
    rows += [(2010, [1.0] * 4, None), (2020, [3e38] * 4, 1), (2030, [1e5, -1e5, 0.0, 0.0], 1), (2031, [1e6, 1e6, 0.0, 0.0], 0), (2032, [1e5] * 4, 1)]
    rows += [(3000 + i, [float(i), 1.0], i % 2) for i in range(12)] + [(4000, [], 1), (4001, [], 1), (4002, [], 0)]
    rows += [(100, rows[100][1], rows[100][2])] * 2  # repeated rows, an anchor among them
    want = brute_force(rows, lambda k: k % 10 == 0)
    assert mined(spark, rows, 10, block_rows=16, chunk_rows=5) == want


def test_hot_labels_and_copies_are_dealt_to_blocks_of_bounded_size(spark):
    rows = [(i, [1.0, 2.0], 1 if i % 3 else i) for i in range(900)] + [(5, [1.0, 2.0], 1)] * 600
    df = spark.createDataFrame(rows, SCHEMA)
    vectors = hn.integer_rows(df).withColumn("row", F.monotonically_increasing_id())
    dealt = hn._parted(vectors.select("*", hn._label_groups(1500, 50)), ["dims", "labels_of"], 50, ["row"])
    assert dealt.groupBy("dims", "labels_of", "part").count().agg(F.max("count")).first()[0] < 100
    assert mined(spark, rows, block_rows=50) == brute_force(rows, lambda k: k % 50 == 0)


@pytest.mark.parametrize("scale", [1, 1 << 22])
def test_candidates_hold_all_rows_that_reach_a_score_and_few_others(scale):
    own_length = [(np.array(v) / np.linalg.norm(v)).tolist() for _, v, _ in clustered(3000)]  # as in a block of one length bucket
    whole = np.array([[math.floor(256 * x) for x in v] for v in own_length], dtype=np.int64) * scale
    vectors = hn.Vectors(np.arange(3000), np.zeros(3000, np.int64), whole)
    block = hn.Block(vectors, np.argsort(vectors.directions, axis=0, kind="stable").T.astype(np.int32))
    anchors = hn.Vectors(np.arange(40), np.zeros(40, np.int64), whole[:40])
    exact = [[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in whole] for x in whole[:40]]
    cut = 0
    for share in (0.2, 0.5, 0.9, 1.0):
        least = np.array([int(max(own) * share) for own in exact], dtype=np.int64)
        looked = dict(block.candidates(anchors, least))
        found = {i: dict(zip(r.tolist(), s.tolist(), strict=True)) for i, r, s in block.scored(anchors, least)}
        for i, own in enumerate(exact):
            want = {r: s for r, s in enumerate(own) if s >= least[i]}
            assert found.get(i, {}) == want
            cut += i in looked and looked[i] is not None and len(looked[i]) < 1000
    assert cut > 60


def test_a_block_too_short_for_the_score_is_passed_over():
    rows = hn.Vectors(np.arange(3), np.zeros(3, np.int64), np.array([[1, 0], [0, 1], [1, 1]]))
    block = hn.Block(rows, np.argsort(rows.directions, axis=0).T.astype(np.int32))
    assert list(block.candidates(hn.Vectors(np.array([9]), np.array([0]), np.array([[10, 0]])), np.array([15]))) == []


def test_empty_tables_and_clashing_columns(spark):
    rows = clustered(300)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "whole", "dims", "row", "slot", "chunk", "bucket", "part", "rank"):
        df = df.withColumn(name, F.lit("mine"))
    found = hn.mine_hard_negatives(df, df.where("vec_id % 50 = 0"))
    assert sorted(tuple(r) for r in found.collect()) == brute_force(rows, lambda k: k % 50 == 0)
    assert hn.mine_hard_negatives(df.limit(0), df.limit(0)).count() == 0
    assert hn.mine_hard_negatives(df, df.limit(0)).count() == 0


def test_anchors_and_blocks_meet_without_a_broadcast_that_grows_with_either(spark):
    rows = clustered(600, 100)
    spark.conf.set("spark.sql.maxBroadcastTableSize", "100m")  # a page takes up to 64 MB; every anchor once for each of 300 blocks: 151 MB
    try:
        found = mined(spark, rows, 1, block_rows=2, chunk_rows=300)
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert found == brute_force(rows, lambda k: True)


@pytest.mark.parametrize("shares", [1, 3])
def test_groups_of_chunks_and_shares_of_blocks_agree_with_brute_force(spark, monkeypatch, shares):
    monkeypatch.setattr(hn, "HELD", 100)
    monkeypatch.setattr(hn, "SHARES", shares)
    rows = clustered(400) + [(1000 + i, [float(i), 1.0], i % 2) for i in range(40)]
    assert mined(spark, rows, 10, block_rows=20, chunk_rows=4) == brute_force(rows, lambda k: k % 10 == 0)


def test_a_task_reports_once_for_all_blocks_it_has_seen(spark):
    df = spark.createDataFrame(clustered(400), SCHEMA)
    dealt = hn.integer_rows(df).select("*", F.lit(0).alias("labels_of"), F.lit(0).alias("bucket"), (F.col("id") % 20).alias("part"))
    asked = hn.integer_rows(df).where("id < 30").select("*", F.lit(0).alias("labels_of"), F.col("id").alias("slot"), (F.col("id") % 3).alias("chunk"))
    blocks = spark.createDataFrame(hn.build_blocks(dealt).collect(), hn.BLOCK)
    assert blocks.count() == 20
    for groups, shares in ((1, 1), (1, 2), (3, 2)):
        found = hn._search(hn._chunks(asked), blocks, groups, shares, ["dims"], lambda own, _: hn.Positives(own, 5))
        assert "CartesianProduct" in found._jdf.queryExecution().executedPlan().toString()
        assert found.count() <= 30 * 5 * shares


def test_whole_numbers_are_packed_by_their_range():
    for top, size in ((127, 1), (128, 2), (-32768, 2), (-32769, 4), (1 << 31, 8)):
        numbers = np.array([[0, 1, -1], [top, 2, 3]])
        data = hn.packed(numbers)
        assert len(data) == 6 * size and (hn.unpacked(data, 2, 3) == numbers).all()
    assert hn.unpacked(hn.packed(np.zeros((3, 0), np.int64)), 3, 0).shape == (3, 0)
