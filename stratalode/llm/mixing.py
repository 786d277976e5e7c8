"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is laid out as a line of words: its documents in the order of a hash,
one pass after another. A tree splits the words that every source gives to the
mix among the output shards: at each node the counts of all sources that go left
are one multivariate-hypergeometric draw, so every shard gets exactly its size
and sources are mixed as a random permutation would mix them. The counts cut each
line into disjoint blocks, one for each shard. Only DataFrame functions touch
documents; the driver holds one row per source.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from decimal import Decimal, localcontext

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalode.sinks import stage

WORD = r"[^\x20\x09-\x0D]+"
_NUMPY_TAKES = 10**8  # its own bound is 10^9
_HALF_LOG_TWO_PI = Decimal("0.918938533204672741780329736405617639861397473637783412817")
_CELLS = 1 << 24  # sources times shards that the driver holds
_CROWDED = 10_000


def targets(sizes: Sequence[int], weights: Sequence[int], share: tuple[int, int] = (3, 2), passes: int = 2) -> list[float]:
    """Words each source gives: ``share`` of all words by weight, none above ``passes`` times its size.

    What is cut off goes to the others by weight, until none is above. The source
    with the least size for its weight is full first, so one walk in that order
    settles all of them.
    """
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: sizes[i] / weights[i])
    left, weight = share[0] * sum(sizes), sum(weights)  # in parts of 1 / share[1] words
    full = share[1] * passes
    for at, i in enumerate(order):
        if left * weights[i] < full * sizes[i] * weight:
            for j in order[at:]:
                out[j] = float(left * weights[j]) / float(share[1] * weight)
            break
        out[i] = float(passes * sizes[i])
        left -= full * sizes[i]
        weight -= weights[i]
    return out


def _log_factorial(k: int) -> Decimal:
    """ln k! to about 18 decimals, by Stirling's series where k is not small."""
    if k < 64:
        return Decimal(math.factorial(k)).ln()
    x = Decimal(k)
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    return (x + Decimal("0.5")) * x.ln() - x + _HALF_LOG_TWO_PI + series


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` items drawn from ``good`` and ``bad`` ones are good, at any size.

    Rejection from the hat that every log-concave distribution has around its mode: flat,
    with exponential tails. Chances are ratios of factorials of 45 digits, some 3 ms a
    draw, as doubles cannot tell neighbours apart there.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    with localcontext(prec=45):

        def log_ways(k: int) -> Decimal:
            return -sum(map(_log_factorial, (k, good - k, n - k, bad - n + k)))

        mode = (n + 1) * (good + 1) // (good + bad + 2)
        top = log_ways(mode)
        whole = sum(map(_log_factorial, (good, bad, n, good + bad - n))) - _log_factorial(good + bad)
        peak = float((top + whole).exp())
        width = 1 + peak / 2
        while True:
            inside = rng.random() * (1 + width) <= width
            away = (rng.random() * width if inside else width + rng.exponential()) / peak
            k = mode + int(round(away)) * (1 if rng.random() < 0.5 else -1)
            if low <= k <= high:
                hat = rng.random() * min(1.0, math.exp(width - peak * away))
                if hat <= float((log_ways(k) - top).exp()):
                    return k


def _draw(rng: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` items drawn without replacement come from each source; exact at any size."""
    left = int(counts.sum())
    if left <= _NUMPY_TAKES:
        return rng.multivariate_hypergeometric(counts, n, method="marginals")
    drawn = np.zeros_like(counts)
    for i, count in enumerate(counts.tolist()):
        left -= count
        drawn[i] = _hypergeometric(rng, count, left, n)
        n -= int(drawn[i])
    return drawn


def split_among_shards(quotas: Sequence[int], shards: int, seed: int) -> list[list[int]]:
    """For each source, where its blocks begin and end: ``shards + 1`` increasing positions."""
    parts = np.zeros((shards, len(quotas)), dtype=np.int64)
    todo = [(0, shards, np.array(quotas, dtype=np.int64))]
    while todo:
        first, last, counts = todo.pop()
        if last - first == 1:
            parts[first] = counts
            continue
        middle = (first + last) // 2
        rng = np.random.default_rng([seed, first, last])
        left = _draw(rng, counts, int(counts.sum()) * (middle - first) // (last - first))
        todo += [(first, middle, left), (middle, last, counts - left)]
    bounds = np.zeros((len(quotas), shards + 1), dtype=np.int64)
    bounds[:, 1:] = parts.cumsum(axis=0).T
    return bounds.tolist()


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: tuple[int, int] = (3, 2),
    passes: int = 2,
    shards: int | None = None,
    seed: int = 8,
    rows_per_bucket: int = 4_000,
    words_per_shard: int = 1 << 27,
    max_sources: int = 100_000,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    with_text: bool = False,
) -> DataFrame:
    """One row per document: key, source, size, source_size, target, draws, taken.

    Sources in the order of their code points, NULL last, have ``weights`` in
    turn. ``draws`` lists what the mix takes of the document, as structs of shard,
    pass and the range of words (from_word, to_word); ``taken`` is their length.
    With ``with_text`` each draw also has the ``text`` of its words and the white
    space after them (before them too at the start), so draws side by side join to
    the document's text.
    A document that a block's end falls into is cut there, so every source gives
    its rounded target exactly, and no document is taken more than ``passes`` times.
    Without ``shards`` there are 16, or as many as keep one to ``words_per_shard``.

    NULL and empty texts have size 0 and are never drawn; a NULL key is a key of
    its own; rows with equal keys are put in the order of their sizes and their
    texts' hashes. An empty table gives an empty result. Other columns do not
    matter and are not returned. ``docs`` is read twice and has to give the same rows.

    A source's order is that of the key's MD5, whose leading bits also are its
    bucket: sums by bucket are added up first, then the documents within each
    bucket, so that no task sees a whole source. A bucket that holds far more rows
    than the others, as one key repeats, is dealt out by the texts' hashes. Sources
    go by a number, and what a bucket needs of its source's plan comes with the
    bucket's start, so texts cross the network once and are not written anywhere.
    ``max_sources`` only bounds what the driver holds; beyond it the call is refused.
    """
    number = F.xxhash64(F.lit(seed), F.col(source).isNull(), F.coalesce(F.col(source), F.lit("")))
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    at = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}")))
    measured = docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), number.alias("number"), size.alias("size"), at.alias("at"),
        F.xxhash64(text).alias("tie"), *([F.col(text).alias("text")] if with_text else []),
    )
    sized = stage(measured.drop("text"), "sizes")
    totals = sized.groupBy("source", "number").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    found = totals.limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    if len({r["number"] for r in found}) < len(found):
        raise ValueError("two sources have one number; choose another seed")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in found]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share, passes)
    quotas = [int(np.floor(t + 0.5)) for t in wanted]
    if shards is None:
        shards = max(16, min(-(-sum(quotas) // words_per_shard), _CELLS // max(1, len(found))))
    bounds = split_among_shards(quotas, shards, seed) if found else []
    plan = [
        {"number": r["number"], "source_size": r["size"], "target": t, "bounds": b}
        for r, t, b in zip(found, wanted, bounds, strict=True)
    ]
    rows = F.from_json(
        F.lit(json.dumps(plan)), "array<struct<number: bigint, source_size: bigint, target: double, bounds: array<bigint>>>"
    )
    sources = stage(docs.sparkSession.range(1).select(F.inline(rows)), "mix-plan")

    buckets = max(1, min(1 << 20, -(-max((r["rows"] for r in found), default=1) // rows_per_bucket)))
    part = _part_of_bucket(sized.withColumn("bucket", _bucket(buckets)), rows_per_bucket)
    place = ["number", "bucket", "part"]

    def dealt(df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", _bucket(buckets)).withColumn("part", part)

    earlier = Window.partitionBy("number").orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt(sized).groupBy(*place).agg(F.sum("size").alias("words"))
    starts = starts.withColumn("bucket_start", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    starts = starts.join(sources, "number").select(
        *place, "bucket_start", "source_size", "target", _blocks_met(passes, shards).alias("blocks")
    )
    inside = Window.partitionBy(*place).orderBy("at", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt(measured if with_text else sized).withColumn("upto", F.sum("size").over(inside))
    placed = placed.join(starts, place).withColumn("start", F.col("upto") - F.col("size") + F.col("bucket_start"))
    drawn = placed.select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", "at",
        _draws().alias("draws"), *(["text"] if with_text else []),
    )
    if with_text:
        drawn = drawn.withColumn("draws", F.transform("draws", lambda d: d.withField("text", _piece("text", "size", d)))).drop("text")
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda sum, d: sum + d["to_word"] - d["from_word"])
    return drawn.withColumn("taken", taken)


def _bucket(buckets: int) -> Column:
    return F.floor(F.conv(F.substring("at", 1, 8), 16, 10).cast("long") * buckets / (1 << 32))


def _part_of_bucket(sized: DataFrame, rows_per_bucket: int) -> Column:
    """Which part of its bucket a row belongs to: 0, but for buckets that one repeated key has made large.

    The driver holds a bounded list of such buckets; were there more, all buckets would be parted.
    """
    counts = sized.groupBy("number", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    crowded = counts.where(F.col("rows") > 8 * rows_per_bucket).limit(_CROWDED + 1).collect()
    if not crowded:
        return F.lit(0).cast("long")
    parts = -(-max(r["rows"] for r in crowded) // rows_per_bucket)
    part = F.pmod(F.xxhash64("tie"), F.lit(parts))
    if len(crowded) > _CROWDED:
        return part
    listed = [f"{r['number']}:{r['bucket']}" for r in crowded]
    return F.when(F.concat_ws(":", "number", "bucket").isin(listed), part).otherwise(F.lit(0))


def _blocks_met(passes: int, shards: int) -> Column:
    """The shards' blocks that the words of a bucket can meet, for each pass along its source's line."""

    def of_pass(n: int) -> Column:
        begin = F.col("bucket_start") + F.lit(n) * F.col("source_size")

        def block(shard: Column) -> Column:
            return F.struct(
                shard.alias("shard"), F.lit(n).alias("pass"),
                F.get("bounds", shard).alias("first"), F.get("bounds", shard + 1).alias("last"),
            )

        all_blocks = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), block)
        return F.filter(all_blocks, lambda b: (b["first"] < begin + F.col("words")) & (b["last"] > begin))

    return F.concat(*[of_pass(n) for n in range(passes)])


def _draws() -> Column:
    """Where the document's words on its source's line meet the blocks of the shards."""

    def met(block: Column) -> Column:
        begin = F.col("start") + block["pass"] * F.col("source_size")
        return F.struct(
            block["shard"].alias("shard"),
            block["pass"].alias("pass"),
            (F.greatest(block["first"], begin) - begin).alias("from_word"),
            (F.least(block["last"], begin + F.col("size")) - begin).alias("to_word"),
        )

    return F.filter(F.transform("blocks", met), lambda d: d["to_word"] > d["from_word"])


def _piece(text: str, size: str, draw: Column) -> Column:
    """The words of a draw with the white space after each, and with what is before the first word of the text."""
    first, count = draw["from_word"].cast("int"), (draw["to_word"] - draw["from_word"]).cast("int")
    words, spaces = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)), F.split(F.col(text), WORD, -1)
    parts = F.zip_with(F.slice(words, first + 1, count), F.slice(spaces, first + 2, count), lambda w, s: F.concat(w, s))
    begin = F.when(first == 0, F.get(spaces, F.lit(0))).otherwise("")
    return F.when(count == F.col(size), F.col(text)).otherwise(F.concat(begin, F.array_join(parts, "")))


def shard_rows(mixed: DataFrame, seed: int = 8) -> DataFrame:
    """The mix itself: one row per drawn piece, shards after one another and shuffled within.

    Tasks take ranges of (shard, place in the shuffle), so a large shard is sorted by several.
    """
    pieces = mixed.select(*[c for c in mixed.columns if c not in ("draws", "taken")], F.inline("draws"))
    order = F.xxhash64(F.lit(seed), "at", "pass", "from_word")
    return pieces.repartitionByRange("shard", order).sortWithinPartitions("shard", order)
