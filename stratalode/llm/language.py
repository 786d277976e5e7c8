"""Language identification by interpolated Kneser-Ney character models.

One model per language, its n-grams in sorted hash arrays: a discounted
probability per n-gram and a weight of the lower order per context. A text gets
the language of the lowest cross-entropy per character. Texts that no model
explains as well as it explains its own held-back texts are rejected.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalode.llm.columns import in_share, with_arrow_columns
from stratalode.llm.words import pieces
from stratalode.sinks import stage

ORDER, EDGE, SPACE = 4, 1, 32
UNDETERMINED = "und"
FIELDS = "lang_best string, lang_score double, lang_bits double, lang_rejected boolean"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its 16-bit code: a lower-case letter, or a space for everything else."""
    codes = np.full(0x110000, SPACE, dtype=np.uint16)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            lower = ord(char.lower()[0])
            codes[point] = lower if lower < 0x10000 else 0xE000 + lower % 0x1900
    return codes


@dataclass(frozen=True)
class Text:
    """Codes of some documents, each after three edge marks; the codes of row i end at ends[i]."""

    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    letters: np.ndarray

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams that end at each scored position, and these positions."""
        wide = self.codes.astype(np.uint64)
        packed = np.zeros(len(wide), dtype=np.uint64)
        for back in range(ORDER):
            packed[ORDER - 1 :] |= wide[ORDER - 1 - back : len(wide) - back] << np.uint64(16 * back)
        at = np.flatnonzero(self.codes != EDGE)
        return packed[at], at


def read_text(data: np.ndarray, at: np.ndarray) -> Text:
    """Lower-case letters of UTF-8 rows; each run of anything else is one space."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]
    codes = _letters()[points]
    keep = np.ones(len(codes), dtype=np.bool_)
    keep[1:] = (codes[1:] != SPACE) | (codes[:-1] != SPACE)
    keep[chars[:-1][chars[:-1] < len(codes)]] = True
    before = np.concatenate([[0], np.cumsum(keep)])[chars]
    is_letter = np.concatenate([[0], np.cumsum(codes != SPACE)])[chars]
    edges = 3 * np.arange(1, len(at))
    out = np.full(int(before[-1]) + 3 * (len(at) - 1), EDGE, dtype=np.uint16)
    sizes = np.diff(before)
    out[np.arange(before[-1]) + np.repeat(edges, sizes)] = codes[keep]
    return Text(out, before[:-1] + edges, before[1:] + edges, np.diff(is_letter))


@dataclass(frozen=True)
class KneserNey:
    """Sorted hashes of n-grams and contexts of each order from 2 up, and the lowest order."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    single: tuple[np.ndarray, np.ndarray]
    unseen: float

    def log2(self, packed: np.ndarray) -> np.ndarray:
        """Bits of the last character of each n-gram after the others."""
        p = self.unseen + _found(self.single, packed & np.uint64(0xFFFF), 0.0)
        for order, (grams, contexts) in enumerate(zip(self.grams, self.contexts, strict=True), 2):
            own = packed & _mask(order)
            p = _found(grams, own, 0.0) + _found(contexts, own >> np.uint64(16), 1.0) * p
        return -np.log2(p)


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << 16 * order) - 1)


def _found(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, default: float) -> np.ndarray:
    hashes, values = table
    if not len(hashes):
        return np.full(len(keys), default)
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    return np.where(hashes[at] == keys, values[at], default)


def kneser_ney(packed: np.ndarray, counts: np.ndarray) -> KneserNey:
    """A model from the counts of the n-grams of the highest order.

    Lower orders count the different characters an n-gram follows. Each order has
    one discount, from the numbers of n-grams counted once and twice.
    """
    grams, contexts = [], []
    own, n = packed, counts.astype(np.float64)
    for order in range(ORDER, 1, -1):
        keys, where = np.unique(own & _mask(order), return_inverse=True)
        n = np.bincount(where, weights=n) if order == ORDER else np.bincount(where).astype(np.float64)
        once, twice = float((n == 1).sum()), float((n == 2).sum())
        discount = once / (once + 2 * twice) if once else 0.5
        heads, which = np.unique(keys >> np.uint64(16), return_inverse=True)
        total, kinds = np.bincount(which, weights=n), np.bincount(which)
        grams.append((keys, np.maximum(n - discount, 0) / total[which]))
        contexts.append((heads, discount * kinds / total))
        own = keys
    chars, where = np.unique(own & _mask(1), return_inverse=True)
    follows = np.bincount(where).astype(np.float64)
    share = 0.1  # of characters that were not seen, over all codes
    single = (chars, (1 - share) * follows / follows.sum())
    return KneserNey(grams[::-1], contexts[::-1], single, share / 0x10000)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    models: tuple[KneserNey, ...]
    sharpness: float = 1.0
    limits: tuple[float, ...] = ()

    def bits(self, text: Text) -> np.ndarray:
        """Bits per character of each row (first axis) under each language."""
        packed, at = text.grams()
        rows = len(text.ends)
        out = np.zeros((rows, len(self.languages)))
        if not len(packed):
            return out
        kinds, which = np.unique(packed, return_inverse=True)
        row = np.searchsorted(text.ends, at, side="right")
        for k, model in enumerate(self.models):
            out[:, k] = np.bincount(row, weights=model.log2(kinds)[which], minlength=rows)
        return out / np.maximum(text.ends - text.starts, 1)[:, None]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts by language; an n-gram's 64 bits are sent as a signed number."""
    for batch in batches:
        languages = np.array(batch.column(0).to_pylist(), dtype=object)
        for language in sorted(set(languages)):
            column = batch.column(1).filter(pa.array(languages == language))
            for _, _, data, at in pieces(column):
                keys, n = np.unique(read_text(data, at).grams()[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "gram", "n"]
                )


def fit_languages(
    docs: DataFrame,
    max_per_language: int = 1_000,
    held_back: int = 5,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> LanguageModel:
    """Learn a model for every language from documents with a known language.

    At most ``max_per_language`` documents of each are used, those with the
    smallest hashes of their keys, with their whole texts; every ``held_back``-th
    of them only serves to set the sharpness of scores and the limits of rejection.
    Rows with a NULL text, language or key are left out. Keys are thinned out by
    their hashes before they are ranked, so no task ranks a whole language. Without rows there are no
    languages. The driver holds the n-gram counts of this bounded sample.
    """
    known = docs.where(f"{key} is not null and {lang} is not null")
    keys = known.select(F.col(key).alias("key"), F.col(lang).alias("lang"))
    counts = stage(keys.groupBy("lang").count(), "languages")
    hashed = F.xxhash64(F.lit(7), F.col("key").cast("string"))
    thin = keys.join(counts, "lang").where(in_share(hashed, 2 * max_per_language / F.col("count")))
    order = Window.partitionBy("lang").orderBy(hashed, "key")
    ranked = thin.select("key", "lang").withColumn("nth", F.row_number().over(order))
    chosen = stage(ranked.where(F.col("nth") <= max_per_language).dropDuplicates(["key"]), "language-rows")
    texts = known.where(f"{text} is not null").select(F.col(key).alias("key"), F.col(text).alias("text"))
    sample = stage(texts.join(chosen, "key").select("lang", "nth", "text"), "language-texts")
    learn, check = sample.where(F.col("nth") % held_back != 0), sample.where(F.col("nth") % held_back == 0)
    counted = learn.select("lang", "text").mapInArrow(_counted, "lang string, gram bigint, n bigint")
    rows = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(rows["lang"].unique().to_pylist())
    models = []
    for language in languages:
        own = rows.filter(pc.equal(rows["lang"], language))
        models.append(kneser_ney(own["gram"].to_numpy().view(np.uint64), own["n"].to_numpy()))
    model = LanguageModel(tuple(languages), tuple(models))
    if not languages:
        return model
    shared = docs.sparkSession.sparkContext.broadcast(model)
    measured = with_arrow_columns(
        check.select("lang", "text"), lambda b: [pa.array(_all_bits(shared.value, b.column("text")).tolist())], "bits array<double>"
    )
    seen = measured.select("lang", "bits").toPandas()
    return _calibrated(model, seen)


def _calibrated(model: LanguageModel, seen) -> LanguageModel:
    """Sharpness of the best likelihood of the true languages, and limits of three deviations."""
    seen = seen[seen["lang"].isin(model.languages)]
    if not len(seen):
        return model
    bits = np.array(seen["bits"].tolist())
    true = seen["lang"].map({name: i for i, name in enumerate(model.languages)}).to_numpy()
    best = max((2.0**k for k in range(-2, 7)), key=lambda s: _likelihood(bits, true, s))
    limits = []
    for i in range(len(model.languages)):
        own = bits[true == i, i]
        limits.append(float(own.mean() + 3 * max(own.std(), 0.1)) if len(own) else float("inf"))
    return LanguageModel(model.languages, model.models, best, tuple(limits))


def _likelihood(bits: np.ndarray, true: np.ndarray, sharpness: float) -> float:
    return float(np.log(_shares(bits, sharpness)[np.arange(len(true)), true] + 1e-9).sum())


def _shares(bits: np.ndarray, sharpness: float) -> np.ndarray:
    powers = np.exp(-sharpness * (bits - bits.min(axis=1, keepdims=True)))
    return powers / powers.sum(axis=1, keepdims=True)


def _all_bits(model: LanguageModel, column: pa.Array) -> np.ndarray:
    parts = [model.bits(read_text(data, at)) for _, _, data, at in pieces(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(model.languages)))


def identify_languages(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_best, lang_score (0 to 1), lang_bits and lang_rejected.

    A text that is NULL or has no letter gets ``und`` with score 0 and is rejected,
    as is everything if the model has no languages. Repeated rows stay; columns with
    the names of results are replaced; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> list:
        best, score, least, rejected = [], [], [], []
        model = shared.value
        for _, _, data, at in pieces(batch.column(text)):
            read = read_text(data, at)
            known = (read.letters > 0) & bool(model.languages)
            bits = model.bits(read) if model.languages else np.zeros((len(known), 1))
            k = bits.argmin(axis=1)
            share = _shares(bits, model.sharpness)[np.arange(len(k)), k]
            limit = np.array(model.limits or [np.inf])[k] if len(model.limits or [1]) > k.max(initial=0) else np.full(len(k), np.inf)
            for i in range(len(k)):
                best.append(model.languages[k[i]] if known[i] else UNDETERMINED)
                score.append(float(share[i]) if known[i] else 0.0)
                least.append(float(bits[i, k[i]]) if known[i] else None)
                rejected.append(bool(not known[i] or bits[i, k[i]] > limit[i]))
        return [pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(least, pa.float64()), pa.array(rejected, pa.bool_())]

    return with_arrow_columns(docs, make, FIELDS)
