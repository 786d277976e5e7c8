import random

import pytest

from pyspark.sql import functions as F

from stratalode.llm.components import components
from stratalode.llm.minhash import CUT_LONG, CUT_SHORT, banding, keep_one, most_different, near_duplicates


def sets(text, n):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute_force(rows, n, percent=80):
    shingled = {k: sets(t, n) for k, t in rows}
    root = {k: k for k in shingled}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(shingled)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = shingled[a], shingled[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted((k, len(s), find(k), find(k) == k) for k, s in shingled.items())


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def test_agrees_with_brute_force_on_copies_chains_and_large_groups(spark, rows):
    rng = random.Random(1)
    data, k = [], 1000
    vocabulary = [f"w{i}" for i in range(500)]
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(120)]
        for _ in range(40):
            data.append((k := k - 1, " ".join(edited(rng, base, rng.randrange(8)))))
        data += [((k := k - 1), " ".join(base)) for _ in range(5)]
        chain = base
        for _ in range(15):
            chain = edited(rng, chain, 2)
            data.append((k := k - 1, " ".join(chain).upper()))
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    data += [((k := k - 1), passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 60)))) for _ in range(100)]
    data += [((k := k - 1), f"short text {i % 7}") for i in range(20)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    for n in (4, 5):
        assert rows(near_duplicates(docs, n)) == sorted(brute_force(data, n), key=repr)


def test_bounds_follow_from_the_similarity():
    assert banding(80) == (48, 6)
    assert most_different(128, 80, CUT_SHORT) == 36 and most_different(2048, 80, CUT_LONG) == 275
    for percent in range(1, 100):
        bands, length = banding(percent)
        assert (1 - (percent / 100) ** length) ** bands <= 5e-7
    assert banding(100)[0] == 1 and most_different(128, 100, CUT_SHORT) == 0
    limits = [most_different(2048, p, CUT_LONG) for p in range(1, 101)]
    assert limits == sorted(limits, reverse=True)


@pytest.mark.parametrize(("percent", "changed"), [(30, 53), (50, 33), (70, 17), (95, 2), (100, 0)])
def test_pairs_just_above_other_limits_are_all_linked(spark, rows, percent, changed):
    """Pairs that differ in one stretch at their ends, each slightly more alike than the limit."""
    rng, data = random.Random(percent), []
    for k in range(60):
        words = [f"w{rng.randrange(10**9)}" for _ in range(104)]
        data.append((2 * k, " ".join(words)))
        new = [f"n{rng.randrange(10**9)}" for _ in range(changed)]
        data.append((2 * k + 1, " ".join(words[: 104 - changed] + new)))
    expected = brute_force(data, 5, percent)
    assert sum(kept for *_, kept in expected) == 60
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    assert rows(near_duplicates(docs, 5, percent=percent)) == sorted(expected, key=repr)


def test_chains_at_a_low_limit_agree_with_brute_force(spark, rows):
    rng, data, k = random.Random(9), [], 0
    vocabulary = [f"w{i}" for i in range(300)]
    for _ in range(4):
        base = [rng.choice(vocabulary) for _ in range(80)]
        for _ in range(30):
            data.append((k := k + 1, " ".join(edited(rng, base, rng.randrange(20)))))
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    assert rows(near_duplicates(docs, 4, percent=50)) == sorted(brute_force(data, 4, 50), key=repr)
    with pytest.raises(ValueError):
        near_duplicates(docs, percent=0)


def test_awkward_rows(spark, awkward):
    found = {}
    for r in near_duplicates(awkward, 4).collect():
        found.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert found[1] == [(19, 1, True), (19, 1, True)]
    assert found[2] == [(19, 1, False)]
    assert found[10] == [(23, 1, False)]
    assert found[3] == [(0, 3, True)] and found[4] == [(0, 4, True)] and found[5] == [(0, 5, True)]
    assert sorted(found[None], key=repr) == [(0, None, True), (19, None, True)]
    assert found[9] == [(1, 9, True)]
    kept = keep_one(awkward, near_duplicates(awkward, 4))
    assert kept.columns == awkward.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8, 9]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    found = near_duplicates(docs, 5)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert found.count() == 0
    assert keep_one(docs, found).count() == 0


def test_components_of_chains_stars_and_loops(spark, rows):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300), (301, 300)]
    found = dict(rows(components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    assert all(found[i] == 0 for i in range(51))
    assert all(found[i] == 100 for i in range(100, 160))
    assert found[300] == found[301] == 300
    assert 200 not in found
    assert components(spark.createDataFrame([], "a bigint, b bigint")).select(F.count("*")).first()[0] == 0
