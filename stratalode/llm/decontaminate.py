"""Benchmark decontamination by a broadcast hash set of test n-grams.

Words are runs of letters, digits and all else beyond ASCII, A-Z as a-z. A window
is ``n`` consecutive words of a benchmark item, or a whole item of fewer words.
Every token window of a training text is hashed and looked up; what the set
holds is verified on the words themselves, and the words inside are hit.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalode.functions.names import spare_name
from stratalode.llm.columns import sparing, with_arrow_columns
from stratalode.llm.url_filters import LOWER, UPPER
from stratalode.llm.words import ALPHANUMERIC, combined, find_words, pieces, utf8, window_starts
from stratalode.sinks import stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SLOTS = np.uint64((1 << 22) - 1)
FIELDS = "n_words bigint, n_hit bigint, items array<string>, hit_spans array<struct<from_char: int, to_char: int>>"
SPANS = pa.list_(pa.struct([("from_char", pa.int32()), ("to_char", pa.int32())]))


@dataclass(frozen=True)
class NgramSet:
    """Windows by length: a bitmap and the sorted hashes; and the items of each window by its words."""

    lengths: dict[int, tuple[np.ndarray, np.ndarray]]
    items: dict[bytes, frozenset[str]]


def ngram_set(ids: list, texts: pa.Array, n: int) -> NgramSet:
    data, at = utf8(texts)
    words = find_words(data, at, ALPHANUMERIC)
    hashes = words.hashes()[0]
    items: dict[bytes, set[str]] = {}
    by_length: dict[int, set[int]] = {}
    for i, item in enumerate(ids):
        first, count = int(words.first[i]), int(words.first[i + 1] - words.first[i])
        length = min(n, count)
        for w in range(first, first + count - length + 1) if count else ():
            window = b" ".join(words.text(k) for k in range(w, w + length))
            items.setdefault(window, set()).update([] if item is None else [str(item)])
            by_length.setdefault(length, set()).add(int(combined(hashes, np.array([w]), length)[0]))
    lengths = {}
    for length, found in by_length.items():
        known = np.array(sorted(found), dtype=np.uint64)
        slots = np.zeros(int(_SLOTS) + 1, dtype=np.bool_)
        slots[known & _SLOTS] = True
        lengths[length] = (slots, known)
    return NgramSet(lengths, {k: frozenset(v) for k, v in items.items()})


def _scan(grams: NgramSet, column: pa.Array) -> list:
    n_words, n_hit, items, spans = [], [], [], []
    for i, j, data, at in pieces(column):
        words = find_words(data, at, ALPHANUMERIC)
        hashes = words.hashes()[0]
        hit = np.zeros(len(words.starts), dtype=np.bool_)
        found: dict[int, set[str]] = {}
        for length, (slots, known) in grams.lengths.items():
            begins, _ = window_starts(words.first, length)
            values = combined(hashes, begins, length)
            near = np.flatnonzero(slots[values & _SLOTS])
            place = np.minimum(np.searchsorted(known, values[near]), len(known) - 1)
            for w in begins[near[known[place] == values[near]]]:
                window = b" ".join(words.text(k) for k in range(w, w + length))
                if window in grams.items:
                    hit[w : w + length] = True
                    row = int(np.searchsorted(words.first, w, side="right")) - 1
                    found.setdefault(row, set()).update(grams.items[window])
        upto = np.concatenate([[0], np.cumsum(hit)])
        n_words += words.counts.tolist()
        n_hit += (upto[words.first[1:]] - upto[words.first[:-1]]).tolist()
        items += [sorted(found.get(r, ())) for r in range(j - i)]
        spans += [_spans(words, hit, r, int(at[r])) if r in found else [] for r in range(j - i)]
    return [
        pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())),
        pa.array(spans, SPANS),
    ]


def _spans(words, hit: np.ndarray, row: int, begin: int) -> list[dict]:
    """Runs of hit words of a row, in code points of its text."""
    own = np.flatnonzero(hit[words.first[row] : words.first[row + 1]]) + words.first[row]
    runs = np.split(own, np.flatnonzero(np.diff(own) > 1) + 1)
    end = int(words.ends[own[-1]])
    chars = np.concatenate([[0], np.cumsum((words.data[begin:end] & 0xC0) != 0x80)])
    return [
        {"from_char": int(chars[words.starts[r[0]] - begin]), "to_char": int(chars[words.ends[r[-1]] - begin])} for r in runs
    ]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    max_benchmark_bytes: int = 4 << 20,
    text: str = "text",
    item: str = "item_id",
) -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted) and hit_spans (runs of hit words, in code points).

    NULL and empty texts have no words and no hits; benchmark items without words
    have no windows; an item with a NULL id hits words but is not listed. Repeated
    rows stay. Columns of ``docs`` with the names of results are replaced.

    The set is broadcast only if the benchmark's texts have ``max_benchmark_bytes``
    at most; a larger benchmark is matched by a shuffled join of all windows.
    """
    bench = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where("text is not null")
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > max_benchmark_bytes:
        return _by_join(docs, bench, n, text)
    rows = bench.collect()
    grams = docs.sparkSession.sparkContext.broadcast(
        ngram_set([r["item"] for r in rows], pa.array([r["text"] for r in rows], pa.string()), n)
    )
    return with_arrow_columns(docs, lambda batch: _scan(grams.value, batch.column(text)), FIELDS)


def _by_join(docs: DataFrame, bench: DataFrame, n: int, text: str) -> DataFrame:
    """The same by joins, without limits on the benchmark's size."""
    row, hit, listed_items = (spare_name(docs.columns, c) for c in ("_row", "_covered", "_items"))
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")

    def words(column: str):
        return F.coalesce(F.regexp_extract_all(F.translate(column, UPPER, LOWER), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))

    def windows(list_: str, length):
        last = F.size(list_) - length + 1
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(list_, i, length), " ")))

    items = bench.select("item", words("text").alias("words")).where(F.size("words") > 0)
    items = items.withColumn("length", F.least(F.size("words"), F.lit(n)))
    grams = stage(items.select("item", "length", F.explode(windows("words", F.col("length"))).alias("window")).distinct(), "grams")
    tokens = rows.select(row, words(text).alias("words"))
    hits = None
    for length in sorted(r[0] for r in grams.select("length").distinct().collect()):
        each = tokens.select(row, F.posexplode(windows("words", F.lit(length))).alias("pos", "window"))
        met = each.join(grams.where(F.col("length") == length), "window").select(row, "pos", "length", "item")
        hits = met if hits is None else hits.unionByName(met)
    if hits is not None:
        covered = hits.select(row, F.explode(F.sequence(F.col("pos"), F.expr("pos + length - 1"))).alias("word")).distinct()
        covered = covered.groupBy(row).agg(F.collect_list("word").alias(hit))
        listed = hits.select(row, "item").distinct().groupBy(row).agg(F.array_sort(F.collect_list("item")).alias(listed_items))
        out = rows.join(covered, row, "left").join(listed, row, "left")
    else:
        out = rows.withColumns({hit: F.array().cast("array<int>"), listed_items: F.array().cast("array<string>")})
    return with_arrow_columns(out, lambda batch: _found(batch, text, hit, listed_items), FIELDS).drop(row, hit, listed_items)


def _found(batch: pa.RecordBatch, text: str, hit_words: str, listed: str) -> list:
    """The results of rows whose hit words (from 0) and items are known."""
    n_words, n_hit, spans = [], [], []
    covered = batch.column(hit_words)
    for i, j, data, at in pieces(batch.column(text)):
        words = find_words(data, at, ALPHANUMERIC)
        hit = np.zeros(len(words.starts), dtype=np.bool_)
        own = [covered[r].as_py() or [] for r in range(i, j)]
        for r, places in enumerate(own):
            hit[words.first[r] + np.array(places, dtype=np.int64)] = True
        n_words += words.counts.tolist()
        n_hit += [len(places) for places in own]
        spans += [_spans(words, hit, r, int(at[r])) if places else [] for r, places in enumerate(own)]
    items = [found or [] for found in batch.column(listed).to_pylist()]
    return [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, SPANS)]


def items_digest(items: str = "items"):
    """Lower-case hex SHA-256 of the sorted item ids, joined by commas."""
    return F.sha2(F.array_join(items, ","), 256)


def keep_clean(docs: DataFrame, benchmark: DataFrame, n: int = 10, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; columns as they are."""
    return sparing(docs, FIELDS, lambda rows: find_contamination(rows, benchmark, n, **options).where("n_hit = 0"))


def cut_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """The result of `find_contamination` with its hit spans cut out of the text."""
    ends = F.concat(F.transform("hit_spans", lambda s: s["from_char"]), F.array(F.length(text)))
    starts = F.concat(F.array(F.lit(0)), F.transform("hit_spans", lambda s: s["to_char"]))
    parts = F.zip_with(starts, ends, lambda a, b: F.substring(F.col(text), a + 1, b - a))
    return found.withColumn(text, F.when(F.col(text).isNotNull(), F.array_join(parts, "")))
