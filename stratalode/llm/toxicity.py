"""Toxicity by maximum-scoring segments of token log-odds.

Words get log-odds between toxic and clean training documents under Dirichlet
priors: that of a word's first letters is the share of toxic documents; that of
each longer beginning, and at last of the whole word, is half this share and half
the estimate for the shorter one. What counts is the lower confidence bound where it is above zero;
all else is a small loss per word. One linear scan finds all
maximal scoring segments of a text. By extreme-value statistics a segment of
score S in n words is worth lambda * S - ln(n), and is significant above zero.
The worth of the significant segments, the best segment, the sum of all and the
length are turned into a probability on the training documents, each of which is
scored without its own counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalode.llm.columns import in_share, with_arrow_columns
from stratalode.llm.words import ALPHANUMERIC, Words, find_words, pieces
from stratalode.sinks import stage

PREFIXES = (4, 5, 6, 7)
SLOTS = 1 << 20
FIELDS = "toxicity double, toxic_passages array<struct<from_char: int, to_char: int, score: double>>"


@dataclass(frozen=True)
class ToxicityModel:
    """Documents and toxic documents by hash slot of a feature, and what turns scores into a logit."""

    toxic: np.ndarray
    total: np.ndarray
    base: float
    prior: float = 3.0
    least: float = 4.0
    deviations: float = 2.0
    margin: float = 0.7
    loss: float = 0.25
    rate: float = 1.0
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0, -3.0)


def _features(words: Words) -> list[np.ndarray]:
    """Hash slots of each word's beginnings, -1 where it is no longer than that, and of the word."""
    hashes = words.hashes(PREFIXES)
    lengths = words.ends - words.starts
    slots = [(h % np.uint64(SLOTS)).astype(np.int64) for h in hashes]
    return [np.where(lengths > n, s, -1) for s, n in zip(slots[1:], PREFIXES, strict=True)] + slots[:1]


def _word_scores(model: ToxicityModel, words: Words, labels: np.ndarray | None = None) -> np.ndarray:
    """The lower bound of each word's log-odds where it is positive, else the loss.

    With ``labels`` of the rows, these are training rows and their own counts are
    taken out first.
    """
    own = np.repeat(labels, words.counts).astype(np.float32) if labels is not None else np.float32(0)
    counted = np.float32(labels is not None)
    share = np.full(len(words.starts), model.base, dtype=np.float32)
    toxic, clean = share * model.prior, (1 - share) * model.prior
    for slots in _features(words):
        y, n = model.toxic[slots] - own, model.total[slots] - counted
        known = np.flatnonzero((slots >= 0) & (n >= model.least))
        expected = (share[known] + np.float32(model.base)) / 2
        a = y[known] + model.prior * expected
        b = n[known] - y[known] + model.prior * (1 - expected)
        toxic[known], clean[known], share[known] = a, b, a / (a + b)
    bound = np.log(toxic) - np.log(clean) - model.deviations * np.sqrt(1 / toxic + 1 / clean)
    bound -= np.log(model.base) - np.log(1 - model.base) + model.margin
    return np.where(bound > 0, bound, -model.loss).astype(np.float64)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (from, to, score) of a sequence, in linear time.

    Only positive scores are walked through; the losses between them are summed up.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    # From, to, sum before, sum after, and which kept segment is the last one left of it with a smaller sum before.
    kept: list[tuple[int, int, float, float, int]] = []
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, before, after = i, i + 1, sums[i], sums[i + 1]
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= before:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= after:
                kept.append((start, end, before, after, j))
                break
            start, _, before, _, left = kept[j]
            del kept[j:]
            j = left
    return [(a, b, float(y - x)) for a, b, x, y, _ in kept]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class (column 1) that hold a feature, by slot; slot -1 counts documents."""
    counts = np.zeros((2, SLOTS + 1), dtype=np.int64)
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for i, j, data, at in pieces(batch.column(0)):
            words = find_words(data, at, ALPHANUMERIC)
            slots = _features(words)
            for r in range(j - i):
                own = slice(words.first[r], words.first[r + 1])
                seen = np.unique(np.concatenate([s[own] for s in slots]))
                label = int(toxic[i + r])
                counts[label, seen[seen >= 0]] += 1
                counts[label, SLOTS] += 1
    for label in (0, 1):
        slot = np.flatnonzero(counts[label])
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot), pa.array(np.full(len(slot), label)), pa.array(counts[label][slot])], ["slot", "toxic", "n"]
        )


def _histogram(model: ToxicityModel):
    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in pieces(batch.column(0)):
                scores = _word_scores(model, find_words(data, at, ALPHANUMERIC), np.zeros(j - i))
                values, n = np.unique(np.round(scores * 20).astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], ["bin", "n"])

    return bins


def _rate(bins: dict[int, int], loss: float) -> float:
    """The positive lambda with an expected exp(lambda * score) of 1 over clean words."""
    values = np.array([*bins, 60], dtype=np.float64) / 20
    weights = np.array([*bins.values(), 1], dtype=np.float64)
    weights /= weights.sum()
    if (values * weights).sum() >= 0:
        return 0.1
    low, high = 1e-6, 50.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if (weights * np.exp(middle * values)).sum() < 1 else (low, middle)
    return low


def _logit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 200) -> tuple[float, ...]:
    """Logistic regression by damped Newton steps with a weak penalty; the constant comes last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + 1e-2 * w
        hessian = (x.T * (weight * p * (1 - p))) @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step * min(1.0, 1.0 / max(np.abs(step).max(), 1e-12))
    return tuple(w.tolist())


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    max_per_class: int = 6_000,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> ToxicityModel:
    """Learn from the documents whose keys ``labels`` marks with 0 or 1.

    At most ``max_per_class`` rows of each class are used, those with the smallest
    hashes of their keys, and their whole texts. Rows of ``labels`` with a NULL key
    or label do not count, repeated ones count once, as toxic if any says so.
    Without labelled rows the model calls everything clean. The driver holds two
    counts per hash slot, 2**20 slots whatever the data.
    """
    marks = labels.where(f"{key} is not null and {label} in (0, 1)").groupBy(F.col(key).alias("key"))
    marks = marks.agg(F.max(label).cast("int").alias("toxic"))
    order = F.xxhash64(F.lit(4), F.col("key").cast("string"))
    totals = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    classes = []
    for c in (0, 1):  # thinned out first, so that what meets in one task for the cut is bounded
        thin = marks.where((F.col("toxic") == c) & in_share(order, 2 * max_per_class / max(totals.get(c, 0), 1)))
        classes.append(thin.orderBy(order, "key").limit(max_per_class))
    chosen = stage(classes[0].unionByName(classes[1]), "labelled")
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    sample = stage(texts.join(chosen, "key").select("text", "toxic"), "training")

    counted = sample.mapInArrow(_count, "slot bigint, toxic bigint, n bigint").groupBy("slot")
    counted = counted.agg(F.sum(F.col("n") * F.col("toxic")).alias("toxic"), F.sum("n").alias("n"))
    rows = counted.where((F.col("n") >= ToxicityModel.least) | (F.col("slot") == SLOTS)).toArrow()  # others are never looked at
    counts = np.zeros((2, SLOTS + 1), dtype=np.float32)
    for name, kind in (("toxic", 0), ("n", 1)):
        counts[kind, rows["slot"].to_numpy()] = rows[name].to_numpy()
    toxic, documents = (float(counts[i, SLOTS]) for i in (0, 1))
    first = ToxicityModel(counts[0, :SLOTS], counts[1, :SLOTS], (toxic + 1) / (documents + 2))
    if toxic in (0, documents):
        return first
    bins = sample.where("toxic = 0").mapInArrow(_histogram(first), "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n"))
    plain = replace(first, rate=_rate({r["bin"]: r["n"] for r in bins.collect()}, first.loss))

    def evidence(batch: pa.RecordBatch) -> list:
        rows = _scan(plain, batch.column("text"), batch.column("toxic").to_numpy())
        return [pa.array([e.tolist() for e, _ in rows], pa.list_(pa.float64()))]

    seen = with_arrow_columns(sample, evidence, "evidence array<double>").select("evidence", "toxic").toPandas()
    y = seen["toxic"].to_numpy(np.float64)
    share = {c: totals.get(c, 0) / max((y == c).sum(), 1) for c in (0, 1)}
    weight = np.where(y == 1, share[1], share[0]) / max(share.values())
    return replace(plain, weights=_logit(np.array(seen["evidence"].tolist()), y, weight))


def _scan(model: ToxicityModel, column: pa.Array, labels: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, list]]:
    """For each row what the probability rests on, and the significant segments with their places."""
    for i, j, data, at in pieces(column):
        words = find_words(data, at, ALPHANUMERIC)
        scores = _word_scores(model, words, labels[i:j] if labels is not None else None)
        upto = np.concatenate([[0], np.cumsum(scores > 0)])
        marked = upto[words.first[1:]] > upto[words.first[:-1]]
        for r in range(j - i):
            begin, length = int(words.first[r]), np.log(max(int(words.first[r + 1] - words.first[r]), 1))
            if not marked[r]:
                yield np.array([0.0, 0.0, 0.0, length]), []
                continue
            worth, best, total, passages = 0.0, 0.0, 0.0, []
            for a, b, score in maximal_segments(scores[begin : words.first[r + 1]]):
                value = model.rate * score
                total += value
                best = max(best, value)
                if value > length:
                    worth += value - length
                    passages.append((int(words.starts[begin + a]), int(words.ends[begin + b - 1]), score))
            yield np.array([worth, best, total, length]), [_in_chars(data, int(at[r]), p) for p in passages]


def _in_chars(data: np.ndarray, begin: int, passage: tuple[int, int, float]) -> dict:
    start, end, score = passage
    chars = int(((data[begin:start] & 0xC0) != 0x80).sum())
    return {"from_char": chars, "to_char": chars + int(((data[start:end] & 0xC0) != 0x80).sum()), "score": score}


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with toxicity, a probability, and toxic_passages in code points.

    NULL, empty and wordless texts get the score of a text without toxic passages.
    Repeated rows stay and are scored alike; columns with the names of the results
    are replaced; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passages = pa.list_(pa.struct([("from_char", pa.int32()), ("to_char", pa.int32()), ("score", pa.float64())]))

    def make(batch: pa.RecordBatch) -> list:
        rows = list(_scan(shared.value, batch.column(text)))
        weights = np.array(shared.value.weights)
        logits = np.array([float(e @ weights[:-1] + weights[-1]) for e, _ in rows], dtype=np.float64)
        return [pa.array(1 / (1 + np.exp(-np.clip(logits, -700, 700)))), pa.array([r[1] for r in rows], passages)]

    return with_arrow_columns(docs, make, FIELDS)
