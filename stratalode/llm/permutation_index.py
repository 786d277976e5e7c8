"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in their order. Every pivot has an
inverted file of the vectors that have it among their first ones, with its place.
A query walks through the files of its own pivots, which gives the footrule
distance between its order and that of every vector met; the nearest by footrule
are ranked again by their exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalode.llm.columns import with_arrow_columns
from stratalode.sinks import stage

FOUND = "query_id bigint, vec_id bigint, score double"


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The places in ``pivots`` of the ``length`` nearest ones, nearest first."""
    near = _units(vectors) @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :length].astype(np.int16)


@dataclass(frozen=True)
class InvertedFiles:
    """Postings of one segment: rows and places by pivot, and what each row's order weighs in itself."""

    begins: np.ndarray
    rows: np.ndarray
    places: np.ndarray
    own: int
    count: int
    length: int

    @staticmethod
    def of(orders: np.ndarray, pivots: int) -> InvertedFiles:
        count, length = orders.shape
        flat = orders.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        begins = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))
        return InvertedFiles(
            begins, (by_pivot // length).astype(np.int32), (by_pivot % length).astype(np.int32), length * (length + 1), count, length
        )

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Distance of ``order`` to each row's; a pivot that one of them lacks stands after all others."""
        total = np.full(self.count, self.own, dtype=np.int32)
        for place, pivot in enumerate(order.tolist()):
            file = slice(self.begins[pivot], self.begins[pivot + 1])
            theirs = self.places[file]
            total[self.rows[file]] += np.abs(theirs - place) - (2 * self.length - place - theirs)
        return total


@dataclass(frozen=True)
class Queries:
    ids: np.ndarray
    vectors: np.ndarray
    orders: np.ndarray


def _search(queries, pivots: int, k: int, share: float, least: int, segment_rows: int):
    """Search the segments of a partition and give its ``k`` best rows for each query."""

    def best(segment: list[pa.RecordBatch], found: list[list]) -> None:
        block: Queries = queries.value
        table = pa.Table.from_batches(segment).combine_chunks()
        ids = table["vec_id"].to_numpy()
        units = _units(_matrix(table["vector"].combine_chunks()))
        files = InvertedFiles.of(_matrix(table["pivots"].combine_chunks()).astype(np.int16), pivots)
        keep = min(len(ids), max(least, int(np.ceil(share * len(ids)))))
        for q in range(len(block.ids)):
            distance = files.footrule(block.orders[q])
            near = np.argpartition(distance, keep - 1)[:keep] if keep < len(ids) else np.arange(len(ids))
            near = near[ids[near] != block.ids[q]]
            scores = (units[near] * block.vectors[q]).sum(axis=1)
            for i in np.lexsort((ids[near], -scores))[:k].tolist():
                found[q].append((-float(scores[i]), int(ids[near[i]])))
            found[q] = sorted(found[q])[:k]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Queries = queries.value
        found: list[list] = [[] for _ in block.ids]
        segment: list[pa.RecordBatch] = []
        for batch in batches:
            segment.append(batch)
            if sum(len(b) for b in segment) >= segment_rows:
                best(segment, found)
                segment = []
        if segment:
            best(segment, found)
        rows = [(int(block.ids[q]), v, -s) for q, own in enumerate(found) for s, v in own]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "vec_id", "score"]
        )

    return search


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: it is there, not all zero, and has only finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass(frozen=True)
class PermutationIndex:
    """The posted vectors (vec_id, vector, pivots) and the pivots themselves."""

    rows: DataFrame
    pivots: np.ndarray
    length: int
    count: int
    k: int


def build_index(
    vectors: DataFrame, k: int = 5, pivots: int = 128, length: int = 32, key: str = "vec_id", vector: str = "embedding"
) -> PermutationIndex:
    """Post every usable vector.

    The pivots are a bounded sample: the ``pivots`` vectors with the smallest
    hashes of their keys. Rows with equal vectors share a posting by the ``k + 1``
    smallest keys of the group, as no other can be among the ``k`` nearest of any
    query. Rows with a NULL key, a vector that cannot be compared, or another
    length than most vectors have (the smaller on a tie) take no part.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.col("count").desc(), "size").first()
    size = sizes["size"] if sizes else 0
    rows = rows.where(F.size("vector") == size)
    chosen = rows.orderBy(F.xxhash64(F.lit(5), "vec_id"), "vec_id").limit(pivots).select("vector").collect()
    points = _units(np.array([r["vector"] for r in chosen], dtype=np.float64).reshape(-1, max(size, 1)))
    length = min(length, len(points))
    same = Window.partitionBy("vector").orderBy("vec_id")
    rows = rows.dropDuplicates(["vec_id", "vector"])
    rows = rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).drop("nth")

    def post(batch: pa.RecordBatch) -> list:
        orders = nearest_pivots(_matrix(batch.column("vector")), points, length) if len(batch) else np.zeros((0, 0))
        return [pa.array(orders.tolist(), pa.list_(pa.int16()))]

    posted = stage(with_arrow_columns(rows, post, "pivots array<smallint>"), "postings")
    return PermutationIndex(posted, points, length, posted.count(), k)


def search(
    index: PermutationIndex,
    queries: DataFrame,
    k: int = 5,
    share: float = 0.25,
    least: int = 64,
    segment_rows: int = 4096,
    block: int = 10_000,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each query, its own key excluded.

    The index is read in segments of about ``segment_rows`` rows; of each, ``share``
    by footrule, ``least`` rows at least, are ranked by cosine in double precision,
    ties by the smaller key. Queries are taken in blocks of at most ``block``, which
    bounds what is broadcast. Queries that cannot be compared have no rows; of
    queries with equal keys one counts; an empty index gives an empty result. A ``k``
    above the index's own is refused, as it may lack copies.
    """
    if k > index.k:
        raise ValueError(f"the index was built for the {index.k} nearest, not {k}")
    spark = queries.sparkSession
    asked = queries.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    asked = asked.where(F.col("vec_id").isNotNull() & usable(F.col("vector")) & (F.size("vector") == index.pivots.shape[1]))
    asked = stage(asked.groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries")
    blocks = -(-asked.count() // block)
    parts = max(1, -(-index.count // segment_rows))
    segments = index.rows.repartition(parts, "vec_id")
    found = None
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64(F.lit(6), "vec_id"), F.lit(blocks)) == b).collect()
        own = _units(np.array([r["vector"] for r in rows], dtype=np.float64).reshape(len(rows), -1))
        orders = nearest_pivots(own, index.pivots, index.length)
        sent = spark.sparkContext.broadcast(Queries(np.array([r["vec_id"] for r in rows], dtype=np.int64), own, orders))
        job = _search(sent, len(index.pivots), k, share, least, segment_rows)
        own = segments.mapInArrow(job, FOUND)
        found = own if found is None else found.unionByName(own)
    if found is None:
        found = spark.range(0).select(F.col("id").alias("query_id"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    nearest = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
