import numpy as np
import pytest

from stratalode.llm.permutation_index import InvertedFiles, build_index, search

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(n, d=16, seed=6):
    return np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32)


def brute_force(rows, k):
    usable = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        usable[i] = np.array(v, dtype=np.float64)
    unit = {i: v / np.sqrt((v * v).sum()) for i, v in usable.items()}
    out = {}
    for q in unit:
        if q % 50 == 0:
            scored = sorted((-float((unit[q] * u).sum()), i) for i, u in unit.items() if i != q)
            out[q] = scored[:k]
    return out


def test_recall_order_and_scores(spark):
    data = [(i, v.tolist(), 0) for i, v in enumerate(vectors(3000))]
    df = spark.createDataFrame(data, SCHEMA)
    got = {}
    for r in search(build_index(df), df.where("vec_id % 50 = 0"), segment_rows=500).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    want = brute_force([(i, v) for i, v, _ in data], 5)
    assert got.keys() == want.keys()
    assert all(own == sorted(own) and len(own) == 5 for own in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    exact = {q: dict((i, s) for s, i in brute_force([(i, v) for i, v, _ in data], 3000)[q]) for q in list(want)[:3]}
    assert all(abs(exact[q][i] - s) < 1e-12 for q in exact for s, i in got[q])


def test_equal_vectors_ties_and_blocks(spark):
    base = vectors(4)
    data = [(i, base[i % 2].tolist(), 0) for i in range(200)] + [(i, base[2].tolist(), 1) for i in range(200, 204)]
    df = spark.createDataFrame(data, SCHEMA)
    found = search(build_index(df), df.where("vec_id % 50 = 0"), block=2).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got[0] == [2, 4, 6, 8, 10]
    assert got[50] == got[100] == got[150] == [0, 2, 4, 6, 8]
    assert got[200][:3] == [201, 202, 203] and len(got[200]) == 5


def test_vectors_that_cannot_be_compared_and_empty_tables(spark):
    good = vectors(3, 2).tolist()
    data = [
        (0, good[0], 0), (1, good[1], 0), (50, None, 0), (100, [0.0, 0.0], 0), (150, [1.0, None], 0), (200, [float("nan"), 1.0], 0),
        (250, [float("inf"), 1.0], 0), (None, good[2], 0), (0, good[0], 0), (300, good[2], None),
    ]
    df = spark.createDataFrame(data, SCHEMA).withColumnRenamed("label", "score")
    found = search(build_index(df), df.where("vec_id % 50 = 0")).collect()
    assert {(r["query_id"], r["vec_id"]) for r in found} == {(0, 1), (0, 300), (300, 0), (300, 1)}
    assert len(found) == 4
    empty = df.limit(0)
    assert search(build_index(empty), df).count() == 0
    assert search(build_index(df), empty).count() == 0


def test_footrule_agrees_with_its_definition():
    rng = np.random.default_rng(8)
    orders = np.array([rng.permutation(12)[:5] for _ in range(30)], dtype=np.int16)
    files = InvertedFiles.of(orders, 12)

    def places(order):
        return [list(order).index(p) if p in order else 5 for p in range(12)]

    for query in orders[:5]:
        want = [sum(abs(a - b) for a, b in zip(places(query), places(o), strict=True)) for o in orders]
        assert files.footrule(query).tolist() == want


def test_one_odd_length_and_a_larger_k(spark):
    copies = [(i, [1.0, 2.0, 3.0]) for i in range(12)]
    for odd in range(100, 108):
        df = spark.createDataFrame([*copies, (odd, [1.0, 2.0])], "vec_id bigint, embedding array<double>")
        index = build_index(df, k=10)
        assert index.count == 11 and index.pivots.shape[1] == 3
    assert search(index, df.where("vec_id = 0"), k=10).count() == 10
    with pytest.raises(ValueError, match="built for the 10 nearest"):
        search(index, df, k=11)
