"""Alignment of two tokenizers' tokens by the byte offsets where both end.

Each batch of texts stays in Arrow: token lists are flattened with the index of
their document, token lengths are summed up within each document to byte ends,
and a hash join of both sides on (document, end) gives the common ends, which cut
the tokens into groups. A second join on the group gives the links, and
``Table.group_by`` counts them, so Spark only merges partial counts.

A link's count, in how many documents its pair of ids is linked, needs all
documents: each document's pairs are written to the shared folder and read twice,
once to count and once to look the counts up.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratalode.functions.names import column, spare_name
from stratalode.llm.columns import give_back, rows_per_batch, with_arrow_columns
from stratalode.sinks import stage

FOLDER = "/opt/tokenizers"
PIECE = 1 << 20
ROWS = 500

ALIGNED = (
    "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "link_a array<int>, link_b array<int>, link_n array<int>"
)
COUNTED = "n_best bigint, count_sum bigint"

# How the byte-level vocabulary is read: the cutting pattern is fixed by its kind.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters on which all versions of Unicode agree what is a letter, a number and a space.
_SETTLED = re.compile("[\x00-ɏ‐-‧‰-⁞€]*")


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


@dataclass(frozen=True)
class TokenizerFiles:
    """The contents of the two files; a few MB, read by the driver and sent to the workers."""

    byte_bpe: bytes
    piece_bpe: bytes

    @classmethod
    def read(cls, folder: str = FOLDER, byte_bpe: str = "byte_bpe_50k.json", piece_bpe: str = "piece_bpe_32k.model") -> TokenizerFiles:
        with open(f"{folder}/{byte_bpe}", "rb") as a, open(f"{folder}/{piece_bpe}", "rb") as b:
            return cls(a.read(), b.read())

    def load(self) -> TokenizerPair:
        return _load(self)


class TokenizerPair:
    """Both tokenizers with the bytes of each of their tokens as an Arrow array, by id."""

    def __init__(self, files: TokenizerFiles):
        self.a = Tokenizer.from_str(files.byte_bpe.decode())
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        vocabulary = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        own = {i: bytes(letters[c] for c in t) for i, t in vocabulary.items() if all(c in letters for c in t)}
        self.a_bytes = pa.array([own.get(i, b"") for i in range(max(vocabulary) + 1)], pa.large_binary())
        self.fast = _by_rank(files.byte_bpe, own)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.piece_bpe)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = pa.array(
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)], pa.large_binary()
        )

    def encode_a(self, texts: list[str]) -> pa.Array:
        """Ids of space and text. Texts of settled characters go through the faster of two libraries with the same merges."""
        out: list = [None] * len(texts)
        slow = []
        for i, text in enumerate(texts):
            if self.fast is not None and _SETTLED.fullmatch(text):
                out[i] = self.fast.encode_ordinary(" " + text)
            else:
                slow.append(i)
        for i, found in zip(slow, self.a.encode_batch([" " + texts[i] for i in slow], add_special_tokens=False), strict=True):
            out[i] = found.ids
        return pa.array(out, pa.large_list(pa.int32()))

    def encode_b(self, texts: list[str]) -> pa.Array:
        return pa.array(self.b.encode(texts, num_threads=1) if texts else [], pa.large_list(pa.int32()))


@functools.lru_cache(maxsize=1)
def _load(files: TokenizerFiles) -> TokenizerPair:
    return TokenizerPair(files)


def _by_rank(source: bytes, own: dict[int, bytes]) -> tiktoken.Encoding | None:
    """The same byte pair encoding by ranks, if the ids are in the order of the merges and the cutting is the usual one."""
    model, cutting = json.loads(source)["model"], json.loads(source)["pre_tokenizer"] or {}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    if cutting.get("type") != "ByteLevel" or cutting.get("add_prefix_space") or not cutting.get("use_regex", True):
        return None
    ranks = {own[i]: i for i in range(256 + len(merges))}
    return tiktoken.Encoding("ranks", pat_str=_CUT, mergeable_ranks=ranks, special_tokens={})


def _tokens(ids: pa.Array, vocabulary: pa.Array) -> tuple[pa.Table, pa.Array]:
    """One row per token: document, id, byte end within the document; and the tokens' bytes."""
    doc, flat = pc.list_parent_indices(ids), pc.list_flatten(ids)
    held = vocabulary.take(flat)
    ends = pc.cumulative_sum(pc.binary_length(held).cast(pa.int64()))
    firsts = ids.offsets.to_numpy()[:-1]
    padded = np.concatenate([[0], ends.to_numpy(zero_copy_only=False)])
    within = pc.subtract(ends, pa.array(padded[firsts]).take(doc)) if len(flat) else ends
    return pa.table({"doc": doc, "id": flat, "end": within}), held


def _spells(ids: pa.Array, held: pa.Array, texts: list[bytes]) -> np.ndarray:
    """Which documents their tokens' bytes spell."""
    at = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1][ids.offsets.to_numpy()]
    data = memoryview(held.buffers()[2]) if held.buffers()[2] is not None else memoryview(b"")
    return np.array([data[a:b].tobytes() == t for a, b, t in zip(at[:-1].tolist(), at[1:].tolist(), texts, strict=True)], dtype=np.bool_)


def _counted(rows: pa.Table, keys: list[str]) -> pa.Table:
    return rows.group_by(keys, use_threads=False).aggregate([([], "count_all")])


def links(a: pa.Table, b: pa.Table) -> pa.Table:
    """Linked id pairs of each document: (doc, a, b, n), n being their occurrences.

    Tokens have the columns doc, id and group. Where groups are long, equal ids of
    a group are counted first, so that a group never gives more rows than pairs of
    different ids.
    """
    n_a, n_b = _counted(a, ["group"]), _counted(b, ["group"])
    sizes = n_a.join(n_b, "group", join_type="inner", right_suffix="_b", use_threads=False)
    pairs = pc.sum(pc.multiply(sizes["count_all"], sizes["count_all_b"])).as_py() or 0
    if pairs <= 8 * (len(a) + len(b)):
        met = a.join(b.select(["group", "id"]), "group", join_type="inner", right_suffix="_b", use_threads=False)
        found = _counted(met, ["doc", "id", "id_b"]).rename_columns(["doc", "a", "b", "n"])
    else:
        left, right = _counted(a, ["doc", "group", "id"]), _counted(b, ["group", "id"])
        met = left.join(right, "group", join_type="inner", right_suffix="_b", use_threads=False)
        met = met.append_column("n", pc.multiply(met["count_all"], met["count_all_b"]))
        found = met.group_by(["doc", "id", "id_b"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["doc", "a", "b", "n"])
    return found.sort_by([("doc", "ascending"), ("a", "ascending"), ("b", "ascending")])


def _listed(values: pa.Array, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def _joined(values: pa.Array, counts: np.ndarray, by: str) -> pa.Array:
    return pc.binary_join(_listed(values.cast(pa.string()), counts), by)


def align_texts(texts: list[str | None], pair: TokenizerPair) -> list[pa.Array]:
    """The columns of ``ALIGNED`` for some texts."""
    n = len(texts)
    rows = [i for i, t in enumerate(texts) if t]
    own = [texts[i] for i in rows]
    ids_a, ids_b = pair.encode_a(own), pair.encode_b(own)
    (a, bytes_a), (b, bytes_b) = _tokens(ids_a, pair.a_bytes), _tokens(ids_b, pair.b_bytes)
    wanted = [b" " + t.encode() for t in own]
    good = _spells(ids_a, bytes_a, wanted) & _spells(ids_b, bytes_b, wanted)
    del bytes_a, bytes_b, wanted
    at = pa.array(np.array(rows, dtype=np.int64))
    kept = pa.array(good)

    def of_good(tokens: pa.Table) -> pa.Table:
        tokens = tokens if good.all() else tokens.filter(kept.take(tokens["doc"]))
        tokens = tokens.set_column(0, "doc", at.take(tokens["doc"]).combine_chunks() if len(tokens) else pa.array([], pa.int64()))
        return tokens.append_column("row", pa.array(np.arange(len(tokens))))

    a, b = of_good(a), of_good(b)
    cuts = a.select(["doc", "end", "row"]).join(
        b.select(["doc", "end", "row"]), ["doc", "end"], join_type="inner", right_suffix="_b", use_threads=False
    )
    cuts = cuts.sort_by("row")
    cut_doc = cuts["doc"].to_numpy()

    def grouped(tokens: pa.Table, last: np.ndarray) -> tuple[pa.Table, np.ndarray]:
        """Tokens with their group, and the groups' lengths: a group ends with the token of a cut."""
        lengths = np.diff(np.concatenate([[-1], last]))
        return tokens.append_column("group", pa.array(np.repeat(np.arange(len(last)), lengths))), lengths

    a, lengths_a = grouped(a.select(["doc", "id"]), cuts["row"].to_numpy())
    b, lengths_b = grouped(b.select(["doc", "id"]), cuts["row_b"].to_numpy())
    n_groups = np.bincount(cut_doc, minlength=n)
    each = pc.binary_join_element_wise(
        _joined(a["id"].combine_chunks(), lengths_a, ","), _joined(b["id"].combine_chunks(), lengths_b, ","), "|"
    )
    text = _joined(each, n_groups, ";")
    found = links(a, b)
    per_doc = np.bincount(found["doc"].to_numpy(), minlength=n)
    n_links = np.bincount(found["doc"].to_numpy(), weights=found["n"].to_numpy(), minlength=n).astype(np.int64)
    counts = [np.bincount(t["doc"].to_numpy(), minlength=n) for t in (a, b)]
    return [
        *(pa.array(c.astype(np.int64)) for c in (*counts, n_groups, n_links)), text,
        *(_listed(found[c].combine_chunks().cast(pa.int32()), per_doc) for c in ("a", "b", "n")),
    ]


def _pieces(column_: pa.Array) -> Iterator[list[str | None]]:
    """Runs of texts of about ``PIECE`` bytes, or one text where that is longer."""
    run: list[str | None] = []
    size = 0
    for value in column_:
        text = value.as_py()
        if run and size + len(text or "") > PIECE:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text or "")
    if run:
        yield run


def align_tokens(docs: DataFrame, files: TokenizerFiles | None = None, text: str = "text") -> DataFrame:
    """``docs`` with the alignment of two tokenizers' tokens of each text.

    ``groups`` lists the groups in order, as ids of the first and of the second
    tokenizer: ``a1,a2|b1;a3|b2,b3``. ``link_a``, ``link_b`` and ``link_n`` list the
    id pairs that share a group and how often, n_links being their sum.

    NULL and empty texts, and texts that the bytes of either tokenizer's tokens do
    not spell (after one space), have no tokens: zeros and empty results. Repeated
    rows stay; columns with the names of the results are replaced; an empty table
    gives an empty result. Memory follows 1 MB of text, or one text where that is
    longer.
    """
    shared = docs.sparkSession.sparkContext.broadcast(files or TokenizerFiles.read())

    def make(batch: pa.RecordBatch) -> list:
        pa.set_cpu_count(1)  # Spark runs one task per core
        pair = shared.value.load()
        parts = [align_texts(run, pair) for run in _pieces(batch.column(text))] or [align_texts([], pair)]
        columns = [pa.chunked_array(c).combine_chunks() for c in zip(*parts, strict=True)]
        return columns

    return with_arrow_columns(docs, make, ALIGNED)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per id pair, added up within the task while that takes little memory."""
    names = ["a", "b", "docs"]
    held: list[pa.Table] = []

    def merged() -> pa.Table:
        rows = pa.concat_tables(held)
        return rows.group_by(["a", "b"], use_threads=False).aggregate([("docs", "sum")]).rename_columns(names)

    for batch in batches:
        pairs = pa.table({"a": pc.list_flatten(batch.column(0)), "b": pc.list_flatten(batch.column(1))})
        held.append(_counted(pairs, ["a", "b"]).rename_columns(names))
        if sum(map(len, held)) > 1 << 21:
            held = [merged()]
            if len(held[0]) > 1 << 20:
                yield from held[0].combine_chunks().to_batches()
                held = []
    if held:
        yield from merged().combine_chunks().to_batches()
    give_back()


def count_pairs(aligned: DataFrame) -> DataFrame:
    """Linked id pairs of the corpus (a, b), in how many documents they are linked, and whether that is most for ``a``."""
    partial = aligned.select("link_a", "link_b").mapInArrow(_partial_counts, "a int, b int, docs bigint")
    counts = stage(partial.groupBy("a", "b").agg(F.sum("docs").alias("docs")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(most, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))


def with_counts(aligned: DataFrame, max_pairs: int = 4_000_000) -> DataFrame:
    """The result of `align_tokens` with n_best and count_sum.

    A pair's count is the number of documents that have it linked; n_best counts
    the links whose pair has the highest count of its first id, ties included, and
    count_sum adds up the counts over all links. ``aligned`` is read twice, so it
    should be staged. Counts of up to ``max_pairs`` pairs (16 bytes each) are sent
    to the tasks; more are joined.
    """
    counts = stage(count_pairs(aligned), "pairs")
    spark = aligned.sparkSession
    if counts.count() > max_pairs:
        return _by_join(aligned, counts)
    rows = counts.toArrow()
    key = rows["a"].to_numpy().astype(np.int64) << 32 | rows["b"].to_numpy()
    order = np.argsort(key)
    docs = rows["docs"].to_numpy()[order] << 1 | rows["best"].to_numpy(zero_copy_only=False)[order]
    shared = spark.sparkContext.broadcast((key[order], docs))

    def make(batch: pa.RecordBatch) -> list:
        keys, known = shared.value
        lists = batch.column("link_a")
        doc = pc.list_parent_indices(lists).to_numpy()
        flat = [pc.list_flatten(batch.column(c)).to_numpy().astype(np.int64) for c in ("link_a", "link_b", "link_n")]
        value = known[np.searchsorted(keys, flat[0] << 32 | flat[1])]
        best, total = np.zeros(len(lists), dtype=np.int64), np.zeros(len(lists), dtype=np.int64)
        np.add.at(best, doc, flat[2] * (value & 1))
        np.add.at(total, doc, flat[2] * (value >> 1))
        return [pa.array(best), pa.array(total)]

    return with_arrow_columns(aligned, make, COUNTED)


def _by_join(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a join on the pairs; a pair that many documents hold is split by adaptive execution."""
    aligned = aligned.drop(*[c for c in aligned.columns if c.lower() in ("n_best", "count_sum")])
    row = spare_name(aligned.columns, "_row")
    rows = stage(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned-rows")
    pairs = rows.select(row, F.inline(F.arrays_zip(F.col("link_a").alias("a"), F.col("link_b").alias("b"), F.col("link_n").alias("n"))))
    pairs = pairs.toDF(row, "a", "b", "n").join(counts, ["a", "b"])
    sums = pairs.groupBy(row).agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).cast("bigint").alias("n_best"), F.sum(F.col("n") * F.col("docs")).alias("count_sum")
    )
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_best", "count_sum")]
    return rows.join(sums, row, "left").select(*[column(c) for c in rows.columns if c != row], *zeros)


def staged_alignment(aligned: DataFrame) -> DataFrame:
    """`align_tokens` written to the shared folder, by small batches as tokens take many times the room of their texts."""
    with rows_per_batch(aligned.sparkSession, ROWS):
        return stage(aligned, "aligned")


def groups_digest(groups: str = "groups"):
    """Lower-case hex SHA-256 of the groups; empty without tokens."""
    return F.when(F.col(groups) == "", "").otherwise(F.sha2(groups, 256))

