"""Hard negatives by inner product, found with length buckets and sorted coordinate lists.

Rows are dealt into blocks of bounded size: rows of one dimension, of about the
same length, and of one group of labels. A block holds, for every coordinate, its
rows in the order of that coordinate of their directions. A row reaches a score
with an anchor only if its direction is close enough to the anchor's, and then
each of its coordinates lies in a range that follows from the anchor's own. So
for an anchor's focus coordinates, its largest ones, the rows in range are cut
out of the sorted lists and intersected; what is left is scored in integers.
Blocks too short to reach the score are passed over.

The score to reach rises while blocks are looked through: first an anchor's best
rows of its own label are found, its positives; then, for each of them, the best
rows of other labels within a band below the positive's score.

Anchors meet the blocks in chunks. Both are rows of binary arrays. A task holds a
group of chunks of bounded size and streams a share of the blocks past them, as a
cartesian product does: nothing is broadcast or copied for it. It reports once, so
what the shares have found for an anchor grows with their number only.
"""

from __future__ import annotations

import contextlib
import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalode.functions.names import column
from stratalode.llm.columns import give_back, rows_per_batch
from stratalode.sinks import stage

SCALE = 256
FOCUS = 4
BATCH = 8  # pairs of a chunk and a block in an Arrow batch, and blocks that are read at once
HELD = 1 << 20  # components of the anchors that a task holds
SHARES = 32  # of the blocks, unless anchors are so few that more of them report no more rows than there are
_EXACT = 2.0**53
_TOO_LONG = 2.0**62
_SLACK = 1e-9

BLOCK = "dims int, labels_of int, longest double, ids binary, labels binary, vectors binary, orders binary"
CHUNK = "dims int, labels_of int, chunk bigint, ids binary, labels binary, vectors binary, places binary, scores binary"


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in the narrowest type that holds them all."""
    kinds = (np.int8, np.int16, np.int32) if numbers.size else ()
    kind = next((k for k in kinds if np.iinfo(k).min <= numbers.min() and numbers.max() <= np.iinfo(k).max), np.int64)
    return np.ascontiguousarray(numbers, kind).tobytes()


def unpacked(data: bytes, *shape: int) -> np.ndarray:
    kind = {1: np.int8, 2: np.int16, 4: np.int32}.get(len(data) // max(1, math.prod(shape)), np.int64)
    return np.frombuffer(data, kind).astype(np.int64).reshape(shape)


@dataclass
class Vectors:
    """Integer vectors of a block or chunk with their ids, labels, lengths and directions."""

    ids: np.ndarray
    labels: np.ndarray
    whole: np.ndarray

    def __post_init__(self):
        values = self.whole.astype(np.float64)
        self.lengths = np.sqrt((values * values).sum(axis=1))
        self.directions = values / np.where(self.lengths > 0, self.lengths, 1.0)[:, None]
        self.values = values

    @classmethod
    def unpack(cls, row: dict, dims: int) -> Vectors:
        ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        return cls(ids, labels, unpacked(row["vectors"], len(ids), dims))

    def products(self, rows: np.ndarray | slice, other: Vectors, others: np.ndarray) -> np.ndarray:
        """Exact inner products: in doubles if these hold all sums that can occur, else in integers."""
        longest = self.lengths.max(initial=0.0) * other.lengths.max(initial=0.0)
        if longest < _EXACT / 4:
            return (self.values[rows] @ other.values[others].T).astype(np.int64)
        return self.whole[rows] @ other.whole[others].T


def feasible(direction: np.ndarray, reached: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The range of a coordinate in all directions whose cosine with the given one is at least ``reached``."""
    own, apart = np.arccos(np.clip(direction, -1, 1)), np.arccos(np.clip(reached, -1, 1))
    return np.cos(np.minimum(own + apart, np.pi)) - _SLACK, np.cos(np.maximum(own - apart, 0)) + _SLACK


@dataclass
class Block:
    rows: Vectors
    orders: np.ndarray  # for each coordinate, the rows in the order of it

    @functools.cached_property
    def ordered(self) -> np.ndarray:
        """For each coordinate, its values in the order of it."""
        return np.take_along_axis(self.rows.directions.T, self.orders, axis=1)

    def ranges(self, focus: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the orders of the ``focus`` coordinates the values from ``low`` to ``high`` begin and end."""
        starts, ends = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
        for f in np.unique(focus).tolist():
            at = focus == f
            starts[at] = self.ordered[f].searchsorted(low[at])
            ends[at] = self.ordered[f].searchsorted(high[at], side="right")
        return starts, ends

    def candidates(self, anchors: Vectors, least: np.ndarray) -> Iterator[tuple[int, np.ndarray | None]]:
        """For each anchor the rows that can have a score of at least ``least``; None stands for all rows."""
        longest = self.rows.lengths.max(initial=0.0)
        reach = anchors.lengths * longest
        cosine = np.divide(least, reach, out=np.where(least > 0, 2.0, -1.0), where=reach > 0)
        focus = np.argsort(-np.abs(anchors.directions), axis=1, kind="stable")[:, :FOCUS]
        able = cosine <= 1 + _SLACK
        limited = able & (cosine > 0) & (focus.shape[1] > 0)
        yield from ((i, None) for i in np.flatnonzero(able & ~limited).tolist())
        some = np.flatnonzero(limited)
        if not len(some):
            return
        low, high = feasible(anchors.directions[some[:, None], focus[some]], cosine[some, None])
        starts, ends = self.ranges(focus[some], low, high)
        for j, (i, first) in enumerate(zip(some.tolist(), np.argmin(ends - starts, axis=1).tolist(), strict=True)):
            a, b = starts[j, first], ends[j, first]
            if b - a > len(self.rows.ids) // 2:  # most rows are in every range: scoring them costs less than sorting them out
                yield i, None
                continue
            found = self.orders[focus[i, first]][a:b]
            for k, f in enumerate(focus[i].tolist()):
                if k != first and len(found):
                    own = self.rows.directions[found, f]
                    found = found[(own >= low[j, k]) & (own <= high[j, k])]
            if len(found):
                yield i, np.sort(found)

    def scored(self, anchors: Vectors, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each anchor its candidate rows that do reach ``least``, with their scores."""
        everything = []
        for i, found in self.candidates(anchors, least):
            if found is None:
                everything.append(i)
                continue
            scores = self.rows.products(found, anchors, np.array([i]))[:, 0]
            kept = scores >= least[i]
            if kept.any():
                yield i, found[kept], scores[kept]
        for at in range(0, len(everything), 64):
            some = np.array(everything[at : at + 64])
            scores = self.rows.products(slice(None), anchors, some)
            reached = scores >= least[some]
            for k in np.flatnonzero(reached.any(axis=0)).tolist():
                kept = np.flatnonzero(reached[:, k])
                yield int(some[k]), kept, scores[kept, k]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


_NONE = np.iinfo(np.int64).min


@dataclass
class Positives:
    """The best rows of an anchor's label so far."""

    anchors: Vectors
    k: int

    def __post_init__(self):
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in self.anchors.ids]
        self.least = np.full(len(self.anchors.ids), _NONE, dtype=np.int64)

    def look(self, block: Block) -> None:
        for i, rows, scores in block.scored(self.anchors, self.least):
            ids = block.rows.ids[rows]
            fit = (block.rows.labels[rows] == self.anchors.labels[i]) & (ids != self.anchors.ids[i])
            scores, ids = (np.concatenate(x) for x in zip(self.found[i], (scores[fit], ids[fit]), strict=True))
            best = _best(scores, ids, self.k)
            self.found[i] = scores[best], ids[best]
            if len(best) == self.k:
                self.least[i] = scores[best[-1]]

    def rows(self) -> Iterator[tuple]:
        for i, (scores, ids) in enumerate(self.found):
            for score, other in zip(scores.tolist(), ids.tolist(), strict=True):
                yield i, 0, other, score


@dataclass
class Negatives:
    """The best rows of other labels so far in the band of each positive; positives of score below 0 have none."""

    anchors: Vectors
    scores: np.ndarray
    k: int
    band: tuple[int, int]

    def __post_init__(self):
        n, places = self.scores.shape
        held = self.scores >= 0
        self.low = np.where(held, -(-self.scores * self.band[0] // 100), 0)
        self.high = np.where(held, self.scores * self.band[1] // 100, -1)
        self.least = np.where(held, self.low, np.iinfo(np.int64).max)
        self.found = [[(np.zeros(0, np.int64), np.zeros(0, np.int64))] * places for _ in range(n)]

    def look(self, block: Block) -> None:
        for i, rows, scores in block.scored(self.anchors, self.least.min(axis=1)):
            fit = np.flatnonzero((block.rows.labels[rows] != self.anchors.labels[i]) & (scores <= self.high[i].max()))
            if not len(fit):
                continue
            scores, ids = scores[fit], block.rows.ids[rows[fit]]
            for p in range(self.scores.shape[1]):
                inside = (scores >= self.least[i, p]) & (scores <= self.high[i, p])
                if not inside.any():
                    continue
                merged = [np.concatenate(x) for x in zip(self.found[i][p], (scores[inside], ids[inside]), strict=True)]
                best = _best(*merged, self.k)
                self.found[i][p] = merged[0][best], merged[1][best]
                if len(best) == self.k:
                    self.least[i, p] = merged[0][best[-1]]

    def rows(self) -> Iterator[tuple]:
        for i, places in enumerate(self.found):
            for p, (scores, ids) in enumerate(places):
                for score, other in zip(scores.tolist(), ids.tolist(), strict=True):
                    yield i, p, other, score


def integer_rows(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """The rows that take part: id, label, whole (``floor(256 * x)``), dims and length."""
    x = column(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf")))
    scaled = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(SCALE))).cast("double"))
    square = F.aggregate(scaled, F.lit(0.0), lambda sum, v: sum + v * v)
    rows = vectors.where(column(key).isNotNull() & column(label).isNotNull() & x.isNotNull() & finite)
    rows = rows.select(column(key).cast("bigint").alias("id"), column(label).cast("bigint").alias("label"), scaled.alias("whole"), square.alias("square"))
    return rows.where(F.col("square") < _TOO_LONG).select(
        "id", "label", F.col("whole").cast("array<bigint>").alias("whole"), F.size("whole").alias("dims"), F.sqrt("square").alias("length")
    )


def _matrix(table: pa.Table) -> np.ndarray:
    lists = table.column("whole").combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(table), -1)


def _parted(rows: DataFrame, keys: list[str], most: int, by: list[str]) -> DataFrame:
    """Rows with ``part``, so that no keys and part have many more than ``most`` rows."""
    counts = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / most).alias("parts"))
    return rows.join(counts, keys).withColumn("part", F.pmod(F.xxhash64(*by), F.col("parts"))).drop("parts")


def _label_groups(rows: int, block_rows: int):
    """Rare labels share blocks: as many groups as there are full blocks."""
    return F.pmod(F.xxhash64("label"), F.lit(max(1, min(1 << 20, rows // block_rows)))).cast("int").alias("labels_of")


def build_blocks(rows: DataFrame) -> DataFrame:
    """One row per block; ``rows`` carry dims, labels_of, bucket and part."""

    def block(keys: tuple, table: pa.Table) -> pa.Table:
        vectors = Vectors(table.column("id").to_numpy(), table.column("label").to_numpy(), _matrix(table))
        orders = np.argsort(vectors.directions, axis=0, kind="stable").T
        dims, labels_of = (k.as_py() for k in keys[:2])
        out = [[dims], [labels_of], [float(vectors.lengths.max())], *([np.ascontiguousarray(a).tobytes()] for a in (vectors.ids, vectors.labels)), [packed(vectors.whole)], [packed(orders)]]
        types = [pa.int32(), pa.int32(), pa.float64(), *[pa.binary()] * 4]
        return pa.table([pa.array(v, t) for v, t in zip(out, types, strict=True)], [f.split()[0] for f in BLOCK.split(", ")])

    return rows.groupBy("dims", "labels_of", "bucket", "part").applyInArrow(block, BLOCK)


def _chunks(anchors: DataFrame) -> DataFrame:
    """One row per chunk; ``anchors`` carry dims, labels_of, chunk, and scores of positives by place where known."""
    with_scores = "scores" in anchors.columns

    def chunk(keys: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("slot", "ascending")])
        n = len(table)
        scores = np.full((n, 0), -1, np.int64)
        if with_scores:
            lists = table.column("scores").to_pylist()
            scores = np.full((n, max(map(len, lists), default=0)), -1, np.int64)
            for i, own in enumerate(lists):
                scores[i, : len(own)] = own
        ids, labels, places, scores = (np.ascontiguousarray(a, np.int64).tobytes() for a in (*(table.column(c).to_numpy() for c in ("id", "label", "slot")), scores))
        values = [[k.as_py()] for k in keys] + [[a] for a in (ids, labels, packed(_matrix(table)), places, scores)]
        types = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
        return pa.table([pa.array(v, t) for v, t in zip(values, types, strict=True)], [f.split()[0] for f in CHUNK.split(", ")])

    return anchors.groupBy("dims", "labels_of", "chunk").applyInArrow(chunk, CHUNK)


@contextlib.contextmanager
def _few_at_once(spark: SparkSession) -> Iterator[None]:
    """Small batches from Parquet and to Python: a block takes megabytes, and Parquet's usual batch is a whole file of them."""
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    spark.conf.set(name, BATCH)
    try:
        with rows_per_batch(spark, BATCH):
            yield
    finally:
        spark.conf.set(name, before)


def _pairs(chunks: DataFrame, blocks: DataFrame, groups: int, shares: int, on: list[str]) -> DataFrame:
    """Each group of chunks with each share of the blocks, in one task: for each block in turn, the chunks.

    Arrays come once: a chunk's with the first block of the task, a block's with the
    first chunk. Pairs that do not ``meet`` are there only if they bring arrays.
    """
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0  # of its partition
    right = chunks.select(*[F.col(c).alias(f"a_{c}") for c in chunks.columns]).repartition(groups).withColumn("first_chunk", first)
    left = blocks.coalesce(shares).select("*", F.monotonically_increasing_id().alias("block"), first.alias("first_block"))
    meet = F.lit(True)
    for c in on:
        meet = meet & (F.col(c) == F.col(f"a_{c}"))
    pairs = left.join(right.hint("shuffle_replicate_nl"), meet | F.col("first_block") | F.col("first_chunk"))
    return pairs.select(
        "block", "first_block", "first_chunk", meet.alias("meet"), "dims", "a_dims", "a_labels_of", "a_chunk",
        *[F.when(F.col("first_chunk"), F.col(c)).alias(c) for c in ("ids", "labels", "vectors", "orders")],
        *[F.when(F.col("first_block"), F.col(c)).alias(c) for c in ("a_ids", "a_labels", "a_vectors", "a_places", "a_scores")],
    )


def _search(chunks: DataFrame, blocks: DataFrame, groups: int, shares: int, on: list[str], start) -> DataFrame:
    """What ``start(chunk)`` finds in the blocks: slot of the anchor, place of the positive, id and score."""
    names = ["slot", "place", "id", "score"]

    def report(search, places: np.ndarray) -> pa.RecordBatch:
        found = list(search.rows())
        columns = list(zip(*found, strict=True)) if found else [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(places[np.array(columns[0], dtype=np.int64)]), *(pa.array(c, pa.int64()) for c in columns[1:])], names
        )

    def opened(row: dict) -> tuple:
        own = {c: row[f"a_{c}"] for c in ("ids", "labels", "vectors")}
        places = np.frombuffer(row["a_places"], np.int64)
        scores = np.frombuffer(row["a_scores"], np.int64).reshape(len(places), -1)
        return start(Vectors.unpack(own, row["a_dims"]), scores), places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        current, block = {}, None
        for batch in batches:
            for row in batch.to_pylist():
                chunk = row["a_dims"], row["a_labels_of"], row["a_chunk"]
                if row["first_block"]:
                    held[chunk] = opened(row)
                if row["first_chunk"]:
                    current, block = row, None
                if not row["meet"]:
                    continue
                if row["block"] != current["block"]:
                    raise RuntimeError("pairs of a block do not follow each other")
                if block is None:
                    rows = Vectors.unpack(current, row["dims"])
                    block = Block(rows, unpacked(current["orders"], row["dims"], len(rows.ids)))
                held[chunk][0].look(block)
        for search, places in held.values():
            yield report(search, places)
        held.clear()
        give_back()

    return _pairs(chunks, blocks, groups, shares, on).mapInArrow(run, "slot bigint, place bigint, id bigint, score bigint")


def mine_hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    band: tuple[int, int] = (50, 95),
    block_rows: int = 4_096,
    chunk_rows: int = 512,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """For each anchor and each of its positives the best rows of other labels within a band.

    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    Components count as ``floor(256 * x)``; scores are their inner products. Of an
    anchor, the first ``positives`` other rows of its label are its positives; for
    each, rows of other labels with a score of ``band`` percent of the positive's are
    ranked and the first ``negatives`` returned. Ties go to smaller ids. The search
    is exact at any size: blocks and chunks only bound what a task holds.

    Rows with a NULL id, label, vector or component, or a component that is not
    finite, take no part, nor do rows whose squared length in integers reaches
    2**62, as their scores need not fit. Only vectors of the same dimension are
    compared. Rows that share an anchor's id are not its partners; repeated rows are
    rows of their own, but a repeated anchor counts once. An empty table gives an
    empty result. Other columns do not matter.
    """
    rows = integer_rows(vectors, key, vector, label)
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n = rows.count()
    groups = _label_groups(n, block_rows)
    bucket = F.when(F.col("length") > 0, F.floor(F.log2("length") * 4)).otherwise(-1).cast("int")
    dealt = _parted(rows.select("*", groups, bucket.alias("bucket")), ["dims", "labels_of", "bucket"], block_rows, ["row"])
    spark = vectors.sparkSession
    asked = integer_rows(anchors, key, vector, label).distinct().select("*", groups)
    asked = _parted(asked, ["dims", "labels_of"], chunk_rows, ["id", "whole"])
    asked = stage(asked.select("*", F.xxhash64("dims", "labels_of", "part").alias("chunk"), F.monotonically_increasing_id().alias("slot")), "anchors")
    n_asked, components = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.greatest("dims", F.lit(1))), F.lit(0))).first()
    groups_of_chunks = max(1, -(-components // HELD))
    shares = max(SHARES, n // max(1, n_asked * positives * negatives))
    with rows_per_batch(spark, block_rows * 2):
        blocks = stage(build_blocks(dealt), "blocks")
        first = stage(_chunks(asked), "chunks")
    with _few_at_once(spark):
        found = _search(first, blocks, groups_of_chunks, shares, ["dims", "labels_of"], lambda own, _: Positives(own, positives))
        found = stage(found, "near-positives")
    order = [F.desc("score"), F.asc("id")]
    by_anchor = Window.partitionBy("slot").orderBy(*order)
    paired = found.withColumn("place", F.row_number().over(by_anchor).cast("bigint") - 1).where(F.col("place") < positives)
    paired = stage(paired, "positives")
    lists = paired.groupBy("slot").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("scores"))
    known = asked.join(lists.hint("merge"), "slot").withColumn("scores", F.transform("scores", lambda s: s["score"]))
    with rows_per_batch(spark, block_rows * 2):
        second = stage(_chunks(known), "chunks")
    with _few_at_once(spark):
        near = _search(second, blocks, groups_of_chunks, shares, ["dims"], lambda own, scores: Negatives(own, scores, negatives, band))
        near = stage(near, "near-negatives")
    by_positive = Window.partitionBy("slot", "place").orderBy(*order)
    near = near.withColumn("rank", F.row_number().over(by_positive)).where(F.col("rank") <= negatives)
    return (
        near.select("slot", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(paired.select("slot", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).hint("merge"), ["slot", "place"])
        .join(asked.select("slot", F.col("id").alias("anchor_id")).hint("merge"), "slot")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
