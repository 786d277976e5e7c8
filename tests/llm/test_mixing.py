import itertools
import math
import random
from collections import Counter
from decimal import Decimal, localcontext

import numpy as np
import pytest

from stratalode.llm.mixing import _draw, _hypergeometric, _log_factorial, mix, shard_rows, split_among_shards, targets


def filled(sizes, weights):
    """Water filling step by step."""
    total, out = 1.5 * sum(sizes), [0.0] * len(sizes)
    open_ = set(range(len(sizes)))
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        above = {i for i in open_ if share[i] > 2 * sizes[i]}
        if not above:
            for i in open_:
                out[i] = share[i]
            break
        for i in above:
            out[i] = 2.0 * sizes[i]
        open_ -= above
    return out


def test_targets_agree_with_water_filling():
    rng = random.Random(4)
    for _ in range(200):
        sizes = [rng.choice([0, 1, 5, 100, 3000]) * rng.randrange(1, 9) for _ in range(rng.randrange(1, 9))]
        weights = list(itertools.islice(itertools.cycle((5, 2, 1)), len(sizes)))
        assert targets(sizes, weights) == pytest.approx(filled(sizes, weights))


def test_tree_splits_quotas_exactly_and_evenly():
    quotas = [1000, 37, 0, 523_456_789_012]
    bounds = split_among_shards(quotas, 7, seed=1)
    assert [b[-1] for b in bounds] == quotas
    assert all(list(b) == sorted(b) and b[0] == 0 for b in bounds)
    shares = [sum(b[i + 1] - b[i] for b in bounds) for i in range(7)]
    assert max(shares) - min(shares) <= 3
    assert bounds == split_among_shards(quotas, 7, seed=1)


def corpus(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(0, 60), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(300)]
    rows.append((300, "long " * 5000, "b"))
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_large_draws_follow_the_exact_distribution():
    """The sampler for large numbers, held against exact chances on small ones."""
    rng = np.random.default_rng(3)
    for good, bad, n in ((7, 5, 6), (40, 3, 20), (30, 90, 50), (1, 1, 1)):
        drawn = Counter(_hypergeometric(rng, good, bad, n) for _ in range(4000))
        chances = {k: math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n) for k in range(n + 1)}
        assert all(chances[k] > 0 for k in drawn)
        likely = [k for k, p in chances.items() if 4000 * p >= 5]
        assert sum((drawn[k] - 4000 * chances[k]) ** 2 / (4000 * chances[k]) for k in likely) < 3 * len(likely) + 12
    assert _hypergeometric(rng, 0, 10**12, 5) == 0 and _hypergeometric(rng, 10**12, 3, 10**12 + 3) == 10**12
    k = 10**13
    with localcontext(prec=45):
        assert abs(_log_factorial(k) - _log_factorial(k - 1) - Decimal(k).ln()) < Decimal("1e-17")


def test_draws_of_ten_thousand_million_words_are_exact_in_units():
    good, bad, n = 4 * 10**9, 6 * 10**9, 5 * 10**9
    rng = np.random.default_rng(5)
    drawn = [int(_draw(rng, np.array([good, bad]), n)[0]) for _ in range(400)]
    mean, deviation = n * good / (good + bad), (n * good / (good + bad) * bad / (good + bad) / 2) ** 0.5
    assert abs(sum(drawn) / 400 - mean) < 4 * deviation / 20
    assert 0.8 < (sum((d - mean) ** 2 for d in drawn) / 400) ** 0.5 / deviation < 1.2
    assert len({d % 100 for d in drawn}) > 90
    parts = _draw(rng, np.array([10**10, 0, 7, 3 * 10**13]), 10**13)
    assert parts.sum() == 10**13 and parts[1] == 0 and 0 <= parts[2] <= 7


def test_draws_meet_targets_and_are_disjoint_blocks(spark):
    mixed = mix(corpus(spark), shards=5, rows_per_bucket=20)
    rows = mixed.collect()
    for source in ("a", "b", "c", None):
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.5
        assert all(r["taken"] <= 2 * r["size"] for r in own)
        assert sum(r["size"] for r in own) == own[0]["source_size"]
    pieces = shard_rows(mixed).collect()
    words = [sum(p["to_word"] - p["from_word"] for p in pieces if p["shard"] == s) for s in range(5)]
    assert max(words) - min(words) <= 5
    seen = {}
    for p in pieces:
        taken = set(range(p["from_word"], p["to_word"]))
        assert not taken & seen.setdefault((p["doc_id"], p["pass"]), set())
        seen[p["doc_id"], p["pass"]] |= taken
        assert max(taken) < p["size"]


def test_reruns_and_other_partitionings_agree(spark, rows):
    docs = corpus(spark)
    assert rows(mix(docs, rows_per_bucket=50)) == rows(mix(docs.repartition(7, "text"), rows_per_bucket=9))


def test_a_key_that_repeats_is_dealt_to_several_tasks(spark, rows):
    data = [(None if i % 3 else i, f"text {i} " + "w " * (i % 7), "ab"[i % 2]) for i in range(900)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    mixed = mix(docs, shards=5, rows_per_bucket=20, with_text=True)
    found = mixed.collect()
    assert len(found) == 900 and sum(r["size"] for r in found) == sum(len(t.split()) for _, t, _ in data)
    for source in "ab":
        own = [r for r in found if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.5
    assert all(len(d["text"].split()) == d["to_word"] - d["from_word"] for r in found for d in r["draws"])
    assert rows(mixed) == rows(mix(docs.repartition(7, "text"), shards=5, rows_per_bucket=20, with_text=True))


def test_texts_are_shuffled_once_and_never_staged(spark, plan):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        mixed = mix(corpus(spark), with_text=True)
        text = plan(mixed)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    with_text = [i for i in exchanges if "AS text#" in "".join(lines[i : i + 4]) or "text#" in "".join(lines[i : i + 4])]
    assert len(exchanges) >= 3 and len(with_text) == 1


def test_shards_follow_the_words(spark):
    mixed = mix(corpus(spark), words_per_shard=500)
    shards = {d["shard"] for r in mixed.collect() for d in r["draws"]}
    assert len(shards) > 30
    assert {r["shard"] for r in shard_rows(mixed).collect()} == shards


def test_awkward_rows_and_empty_tables(spark, awkward):
    found = mix(awkward)
    assert found.count() == awkward.count()
    assert {r["doc_id"] for r in found.where("size = 0").collect()} == {3, 4, 5, None}
    assert found.where("size = 0 and taken <> 0").count() == 0
    assert mix(awkward.limit(0)).count() == 0
    silent = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id bigint, text string, source string")
    assert [tuple(r) for r in mix(silent).select("target", "taken").collect()] == [(0.0, 0), (0.0, 0)]


def test_draws_with_text_are_pieces_of_the_documents(spark, rows):
    texts = {i: "  " * (i % 3) + "".join(f"w{k}\u00e9{' ' if k % 4 else chr(10)}" for k in range(i % 50)) for i in range(300)}
    texts[300] = "long " * 5000
    data = [(i, t, "ab"[i % 3 == 0]) for i, t in texts.items()] + [(None, f"t{k} x y", "b") for k in range(20)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    mixed = mix(docs, shards=5, rows_per_bucket=20, with_text=True)
    assert rows(mixed) == rows(mix(docs.repartition(7, "text"), shards=5, rows_per_bucket=9, with_text=True))
    cut = 0
    for r in mixed.where("doc_id is not null").collect():
        for n in range(2):
            pieces = sorted((d for d in r["draws"] if d["pass"] == n), key=lambda d: d["from_word"])
            for d in pieces:
                assert d["text"].split() == texts[r["doc_id"]].split()[d["from_word"] : d["to_word"]]
                cut += d["to_word"] - d["from_word"] < r["size"]
            if sum(d["to_word"] - d["from_word"] for d in pieces) == r["size"] > 0:
                assert "".join(d["text"] for d in pieces) == texts[r["doc_id"]]
    assert cut > 2
    plain = mix(docs, shards=5).selectExpr("doc_id", "size", "taken")
    assert rows(plain) == rows(mixed.selectExpr("doc_id", "size", "taken"))
    assert "text" in shard_rows(mixed).columns
