import itertools
import random
import time

import numpy as np

from stratalode.llm.toxicity import fit_toxicity, maximal_segments, score_toxicity


def brute_segments(scores):
    """Repeatedly the best segment, then both sides of it."""
    if len(scores) == 0:
        return []
    sums = np.concatenate([[0], np.cumsum(scores)])
    best = max(((sums[b] - sums[a], -(b - a), -a, b) for a, b in itertools.combinations(range(len(sums)), 2)), default=None)
    if best is None or best[0] <= 0:
        return []
    a, b = -best[2], best[3]
    left = brute_segments(scores[:a])
    return left + [(a, b, best[0])] + [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])]


def test_segments_agree_with_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(200):
        scores = rng.normal(-0.3, 1, rng.integers(0, 25))
        got = [(a, b, round(s, 9)) for a, b, s in maximal_segments(scores)]
        assert got == [(a, b, round(s, 9)) for a, b, s in brute_segments(scores)]


def corpus(spark, n=600):
    rng = random.Random(2)
    clean = [f"word{i}" for i in range(300)]
    bad = ["vileword", "nastyterm", "grossname"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        words = [rng.choice(clean) for _ in range(rng.randrange(5, 80))]
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, toxic int"),
    )


def test_held_out_accuracy_and_passages(spark):
    docs, labels = corpus(spark)
    model = fit_toxicity(docs, labels.where("doc_id % 5 <> 0"))
    scored = score_toxicity(docs, model).join(labels, "doc_id").where("doc_id % 5 = 0").collect()
    right = sum((r["toxicity"] >= 0.5) == bool(r["toxic"]) for r in scored)
    assert right >= 0.97 * len(scored)
    one = spark.createDataFrame([(1, "é word1 vileword nastyterm grossname word2")], "doc_id bigint, text string")
    found = score_toxicity(one, model).first()
    assert found["toxicity"] > 0.9
    spans = [(p["from_char"], p["to_char"]) for p in found["toxic_passages"]]
    assert spans == [(8, 36)]


def test_awkward_rows_and_empty_tables(spark, awkward):
    docs, labels = corpus(spark, 300)
    model = fit_toxicity(docs, labels)
    scored = score_toxicity(awkward, model)
    assert scored.count() == awkward.count()
    assert scored.where("toxicity is null or toxicity >= 0.5 or toxicity < 0").count() == 0
    assert score_toxicity(awkward.limit(0), model).count() == 0
    for few in (labels.limit(0), labels.where("toxic = 0"), spark.createDataFrame([(None, 1), (1, None), (2, 7)], "doc_id bigint, toxic int")):
        plain = fit_toxicity(docs, few)
        assert score_toxicity(awkward, plain).where("toxicity >= 0.5").count() == 0
    repeated = fit_toxicity(docs, labels.unionByName(labels))
    assert np.allclose(repeated.weights, model.weights)


def test_segments_of_long_sequences_take_linear_time():
    begun = time.perf_counter()
    assert len(maximal_segments(np.tile([1.0, -2.0], 500_000))) == 500_000
    maximal_segments(np.tile([3.0, -1.0, -1.0], 300_000))
    assert time.perf_counter() - begun < 10
