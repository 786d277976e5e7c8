"""Near-duplicate documents by circulant MinHash, banding and verification.

A first permutation scatters the shingles of a document, a second one, shifted
circularly by one more step for each coordinate, gives all coordinates of the
signature. Both are bijections of 32-bit numbers, so shifting is an addition.

Documents with the same words form one class before anything is compared, so a
group of copies is one node. Bands of the signature gather candidates in two
rounds, neither of which emits all pairs of a bucket: first every member against
the bucket's smallest one; then, in buckets whose members the links found so far
leave in several components, every member outside the largest component against
the members of other components, each pair in the first band it shares and only if
a longer signature leaves it a chance. What is confirmed on the full shingle sets is
joined to connected components on Spark.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalode.llm.columns import give_back, rows_per_batch
from stratalode.llm.components import components
from stratalode.llm.words import UNSPACED, Words, combined, find_words, mixed, pieces, window_starts
from stratalode.sinks import stage

#: One-bit coordinates compared before full sets are fetched, and in the second round.
SKETCH_BITS, LONG_BITS = 128, 2048
#: Chances that a pair exactly at the limit shares no band, differs in more bits of
#: the short sketch than allowed, or of the long one. Pairs above it miss less often.
MISSED, CUT_SHORT, CUT_LONG = 5e-7, 3e-9, 3.2e-7
#: A band holds so many coordinates that a pair at the limit agrees in one band in four.
SHARED, MOST_ROWS = 0.25, 16
#: Rows with one or two whole texts in an Arrow batch.
BATCH_ROWS = 500


def banding(percent: int) -> tuple[int, int]:
    """Bands and coordinates in each for pairs of ``percent`` similarity and more.

    Coordinates agree with the chance of the similarity, so a band of r does with its
    r-th power. At 80 these are 48 bands of 6.
    """
    similarity = percent / 100
    rows = MOST_ROWS if percent == 100 else max(1, min(MOST_ROWS, int(math.log(SHARED) / math.log(similarity))))
    agree = similarity**rows
    return (1 if agree == 1 else math.ceil(math.log(MISSED) / math.log1p(-agree))), rows


def most_different(bits: int, percent: int, chance: float) -> int:
    """Of ``bits`` one-bit coordinates, how many may differ: more do with less than ``chance``.

    Coordinates that differ have different bits half of the time. At 80 these are 36 of
    128 and 275 of 2,048.
    """
    differs = (1 - percent / 100) / 2
    if differs == 0:
        return 0
    tail = 0.0
    for k in range(bits, -1, -1):
        ways = math.lgamma(bits + 1) - math.lgamma(k + 1) - math.lgamma(bits - k + 1)
        tail += math.exp(ways + k * math.log(differs) + (bits - k) * math.log1p(-differs))
        if tail > chance:
            return k
    return 0


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all ``n``-word shingles, how many each row has, and the words' hashes.

    A row of fewer words, but not none, has its whole sequence as the only one.
    """
    hashes = words.hashes()[0]
    at, counts = window_starts(words.first, n)
    values, lengths = combined(hashes, at, n), words.counts
    short = np.flatnonzero((lengths > 0) & (lengths < n))
    if len(short):
        rows = np.repeat(np.arange(len(counts)), counts)
        extra = np.concatenate([combined(hashes, words.first[i : i + 1], int(lengths[i])) for i in short])
        order = np.argsort(np.concatenate([rows, short]), kind="stable")
        values = np.concatenate([values, extra])[order]
        counts = counts.copy()
        counts[short] = 1
    return values, counts, hashes


def signatures(values: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates (rows) of all documents with shingles (columns)."""
    scattered = (mixed(values) >> np.uint64(32)).astype(np.uint32)
    heads = (np.cumsum(counts) - counts)[counts > 0]
    out = np.empty((size, len(heads)), dtype=np.uint32)
    x, y = np.empty_like(scattered), np.empty_like(scattered)
    for k in range(size):
        np.add(scattered, np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF), out=x)
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            np.right_shift(x, np.uint32(shift), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, np.uint32(factor), out=x)
        np.right_shift(x, np.uint32(16), out=y)
        np.bitwise_xor(x, y, out=x)
        out[k] = np.minimum.reduceat(x, heads)
    return out


def _signed(n: int, bands: int, rows: int):
    schema = pa.schema([
        ("id", pa.int64()), ("n_shingles", pa.int64()), ("same", pa.binary()),
        ("s1", pa.int64()), ("s2", pa.int64()), ("bands", pa.list_(pa.int64())),
    ])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in pieces(batch.column(1), 1 << 19):
                words = find_words(data, at, UNSPACED)
                values, counts, hashes = shingles(words, n)
                filled = np.flatnonzero(counts)
                sizes = np.zeros(j - i, dtype=np.int64)
                ends = np.cumsum(counts)
                for r in filled:
                    sizes[r] = len(np.unique(values[ends[r] - counts[r] : ends[r]]))
                same: list[bytes | None] = [None] * (j - i)
                keys: list[np.ndarray | None] = [None] * (j - i)
                sketch = np.zeros((j - i, 2), dtype=np.int64)
                if len(filled):
                    matrix = signatures(values, counts, max(bands * rows, SKETCH_BITS))
                    blocks = matrix[: bands * rows].reshape(bands, rows, -1).astype(np.uint64)
                    steps = np.cumprod(np.full(rows, 0xD1342543DE82EF95, dtype=np.uint64))
                    joint = mixed((blocks * steps[None, :, None]).sum(axis=1) + np.arange(bands, dtype=np.uint64)[:, None])
                    joint = np.ascontiguousarray(joint.T).view(np.int64)
                    bits = np.packbits((matrix[:SKETCH_BITS] & 1).astype(np.uint8).T, axis=1)
                    sketch[filled] = np.ascontiguousarray(bits).view(np.int64)
                    for c, r in enumerate(filled):
                        keys[r] = joint[c]
                        own = hashes[words.first[r] : words.first[r + 1]]
                        same[r] = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i).cast(pa.int64()), pa.array(sizes), pa.array(same, pa.binary()),
                    pa.array(sketch[:, 0]), pa.array(sketch[:, 1]), pa.array(keys, pa.list_(pa.int64())),
                ], schema=schema)
        give_back()

    return sign


def _long(n: int):
    schema = pa.schema([("node", pa.int64()), ("long", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in pieces(batch.column(1), 1 << 19):
                values, counts, _ = shingles(find_words(data, at, UNSPACED), n)
                if not counts.all():
                    raise ValueError("a text without words has no signature")
                bits = np.packbits((signatures(values, counts, LONG_BITS) & 1).astype(np.uint8).T, axis=1)
                longs = pa.array(list(np.ascontiguousarray(bits).view(np.int64)), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), longs], schema=schema)
        give_back()

    return sign


def _confirmed(n: int, percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        for _, _, data, at in pieces(column):
            values, counts, _ = shingles(find_words(data, at, UNSPACED), n)
            for end, count in zip(np.cumsum(counts), counts, strict=True):
                yield np.unique(values[end - count : end])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(sets(batch.column(2)), sets(batch.column(3)), strict=True):
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays(list(batch.filter(pa.array(keep, pa.bool_())).columns[:2]), schema=schema)
        give_back()

    return confirm


def _alike(percent: int) -> Column:
    """Whether two members, x and y, can be similar by their sizes and sketches."""
    sizes = (F.least("x.n", "y.n") * 100) >= (F.greatest("x.n", "y.n") * percent)
    different = sum(F.bit_count(F.col(f"x.{s}").bitwiseXOR(F.col(f"y.{s}"))) for s in ("s1", "s2"))
    return sizes & (different <= most_different(SKETCH_BITS, percent, CUT_SHORT))


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 5,
    percent: int = 80,
    bands: int | None = None,
    rows: int | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: key, n_shingles, component_id, kept.

    Words are runs of anything but white space, A-Z as a-z. Two documents are
    linked where the intersection of their shingle sets is ``percent`` of their
    union or more, a number from 1 to 100; component_id is the smallest key reachable
    by links. ``bands`` and ``rows`` follow from ``percent`` (:func:`banding`), as do
    the limits on sketches; the lower it is, the more bands there are and the more
    candidates have to be compared.

    Texts that are NULL or without words have no shingles and are their own
    component; rows with equal keys are one node; a row with a NULL key is linked
    with nothing, has no component and is kept. An empty table gives an empty
    result; other columns do not matter and are not returned. Sets are compared as
    sets of 64-bit hashes of whole shingles.
    """
    if not 1 <= percent <= 100:
        raise ValueError(f"percent must be from 1 to 100, not {percent}")
    if (bands is None) != (rows is None):
        raise ValueError("bands and rows are given together")
    if bands is None:
        bands, rows = banding(percent)
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    schema = "id bigint, n_shingles bigint, same binary, s1 bigint, s2 bigint, bands array<bigint>"
    with rows_per_batch(spark, BATCH_ROWS):
        signed = stage(texts.mapInArrow(_signed(shingle_words, bands, rows), schema), "signatures")
    filled = signed.where("same is not null and id is not null")
    classes = stage(filled.groupBy("same").agg(F.min("id").alias("node")), "classes")
    nodes = filled.join(classes.withColumn("id", F.col("node")), ["same", "id"])

    posted = nodes.select(F.explode("bands").alias("band"), "node")
    shared = posted.groupBy("band").agg(F.min("node").alias("centre"), F.max("node").alias("last")).where("centre < last")
    members = stage(posted.join(shared.drop("last"), "band").distinct(), "buckets")
    involved = stage(members.select("node").distinct(), "involved")
    facts = nodes.join(involved, "node", "left_semi").groupBy("node").agg(
        *[F.max(c).alias(a) for c, a in (("n_shingles", "n"), ("s1", "s1"), ("s2", "s2"), ("bands", "bands"))]
    )
    facts = stage(facts, "facts")
    wanted = involved.withColumnRenamed("node", "id")
    bodies = stage(texts.join(wanted, "id", "left_semi").where("text is not null"), "bodies")

    def confirm(pairs: DataFrame) -> DataFrame:
        both = (
            pairs.join(bodies.select(F.col("id").alias("a"), F.col("text").alias("a_text")), "a")
            .join(bodies.select(F.col("id").alias("b"), F.col("text").alias("b_text")), "b")
            .select("a", "b", "a_text", "b_text")
        )
        with rows_per_batch(spark, BATCH_ROWS):
            return stage(both.mapInArrow(_confirmed(shingle_words, percent), "a bigint, b bigint").distinct(), "links")

    def described(members: DataFrame) -> DataFrame:
        return members.join(facts, "node")

    pairs = members.where("node <> centre").select("node", "centre").distinct()
    stars = described(pairs).alias("x").join(facts.alias("y"), F.col("x.centre") == F.col("y.node")).where(_alike(percent))
    links = confirm(stars.select(F.col("x.node").alias("a"), F.col("x.centre").alias("b")))

    found = components(links)
    labelled = members.join(found, "node", "left").select(
        "band", "node", "centre", F.coalesce("component", "node").alias("label")
    )
    sizes = labelled.groupBy("band", "label").count()
    mixed_buckets = (
        sizes.groupBy("band")
        .agg(F.max_by("label", F.struct("count", "label")).alias("largest"), F.count(F.lit(1)).alias("labels"))
        .where("labels > 1")
    )
    rest = stage(labelled.join(mixed_buckets, "band").where("node <> centre"), "mixed-buckets")
    apart = bodies.join(rest.select(F.col("node").alias("id")).distinct(), "id", "left_semi").dropDuplicates(["id"])
    with rows_per_batch(spark, BATCH_ROWS):
        longer = stage(apart.mapInArrow(_long(shingle_words), "node bigint, long array<bigint>"), "long-signatures")
    rest = stage(rest.join(facts, "node").join(longer, "node"), "mixed-members")
    first = F.array_position(F.zip_with("x.bands", "y.bands", lambda p, q: p == q), True) - 1
    different = sum(F.bit_count(F.get("x.long", F.lit(i)).bitwiseXOR(F.get("y.long", F.lit(i)))) for i in range(LONG_BITS // 64))
    cross = (
        rest.where("label <> largest").alias("x")
        .join(
            rest.alias("y"),
            (F.col("x.band") == F.col("y.band"))
            & (F.col("x.label") != F.col("y.label"))
            & ((F.col("y.label") == F.col("y.largest")) | (F.col("x.node") < F.col("y.node")))
            & _alike(percent)
            & (different <= most_different(LONG_BITS, percent, CUT_LONG))
            & (F.get("x.bands", first.cast("int")) == F.col("x.band")),
        )
        .select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b"))
        .distinct()
    )
    more = confirm(cross)
    final = links if more.isEmpty() else links.unionByName(more)
    found = found if final is links else components(final)

    by_class = classes.join(found, "node", "left").select("same", F.coalesce("component", "node").alias("component"))
    out = signed.select("id", "n_shingles", "same").join(by_class, "same", "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(key), "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("id"), F.lit(True)).alias("kept")
    )


def keep_one(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that ``found``, the result of `near_duplicates`, does not keep.

    Of kept rows that repeat key and text one stays; rows with a NULL key all stay.
    """
    gone = stage(found.where(f"not kept and {key} is not null").select(key).distinct(), "near-duplicates")
    left = docs.join(gone, key, "left_anti").select(*docs.columns)
    twice = stage(found.where("kept").groupBy(key).count().where(f"count > 1 and {key} is not null").select(key), "repeated-keys")
    if twice.isEmpty():
        return left
    once = left.join(twice, key, "left_semi").select(*docs.columns).dropDuplicates([key, text])
    return left.join(twice, key, "left_anti").select(*docs.columns).unionByName(once)
