import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stratalode.llm import alignment as al
from stratalode.llm import queries

SF_DIR = "/root/testdata/sf0.001"
TEXTS = [
    "The quick brown fox, jumps; over 12345 dogs!", "", None, " ", "  leading and   inner   spaces \n\n\tand tabs", "é漢字 \U0001f600\U0001f468‍\U0001f469 ß",
    "<|endoftext|> <s> </s> <unk> <0x41> are plain", "under▁score", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "x" * 5000 + " y" * 5000,
    "don't we'll I'm they've  odd\u0085spaces", "The quick brown fox, jumps; over 12345 dogs!", "\x00nul\x1f", "हिन्दी ไทย עברית", "ﬁ ligature ½ Ⅷ", "﻿bom �",
]


@pytest.fixture(scope="module")
def pair():
    return al.TokenizerFiles.read().load()


def brute_force(texts, pair):
    """Groups and links of each text token by token; A by the JSON file's own library."""
    a_bytes, b_bytes = pair.a_bytes.to_pylist(), pair.b_bytes.to_pylist()
    groups, held = [], defaultdict(set)
    for row, text in enumerate(texts):
        found = []
        if text:
            a = pair.a.encode(" " + text, add_special_tokens=False).ids
            b = pair.b.encode(text)
            want = (" " + text).encode()
            if b"".join(a_bytes[i] for i in a) == want == b"".join(b_bytes[i] for i in b):
                ends = [set(), set()]
                for side, ids, own in ((0, a, a_bytes), (1, b, b_bytes)):
                    at = 0
                    for i in ids:
                        at += len(own[i])
                        ends[side].add(at)
                cuts = sorted(ends[0] & ends[1])
                i = j = at_a = at_b = 0
                for cut in cuts:
                    left, right = [], []
                    while at_a < cut:
                        left.append(a[i])
                        at_a += len(a_bytes[a[i]])
                        i += 1
                    while at_b < cut:
                        right.append(b[j])
                        at_b += len(b_bytes[b[j]])
                        j += 1
                    found.append((left, right))
        groups.append(found)
        for left, right in found:
            for x in left:
                for y in right:
                    held[x, y].add(row)
    counts = {p: len(rows) for p, rows in held.items()}
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for found in groups:
        met = [(x, y) for left, right in found for x in left for y in right]
        shown = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in found)
        out.append((
            sum(len(g[0]) for g in found), sum(len(g[1]) for g in found), len(found), len(met), sum(counts[p] == most[p[0]] for p in met),
            sum(counts[p] for p in met), hashlib.sha256(shown.encode()).hexdigest() if found else "",
        ))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query_agrees_with_brute_force(spark, pair):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in queries.op12_alignment(spark, SF_DIR).collect()}
    assert rows == {d["doc_id"]: want for d, want in zip(docs, brute_force([d["text"] for d in docs], pair), strict=True)}


@pytest.mark.parametrize("max_pairs", [10**9, 0])
def test_odd_texts_agree_with_brute_force(spark, pair, max_pairs):
    rng = random.Random(5)
    bits = [t for t in TEXTS if t]
    texts = TEXTS + [rng.choice(["", " "]).join(rng.choice(bits)[: rng.randrange(1, 40)] for _ in range(rng.randrange(1, 6))) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    aligned = al.staged_alignment(al.align_tokens(docs))
    found = al.with_counts(aligned, max_pairs).withColumn("groups_sha256", al.groups_digest())
    rows = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in found.collect()}
    assert rows == dict(enumerate(brute_force(texts, pair)))


def test_both_libraries_cut_settled_characters_alike(pair):
    assert pair.fast is not None
    for code in [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]:
        c = chr(code)
        text = f" a{c}b {c}1{c}{c} '{c} x{c} {c}{c}\n{c}"
        assert pair.fast.encode_ordinary(text) == pair.a.encode(text, add_special_tokens=False).ids


def test_long_groups_are_counted_before_they_are_joined():
    import pyarrow as pa

    a = pa.table({"doc": [0] * 5000, "id": [i % 3 for i in range(5000)], "group": [0] * 5000})
    b = pa.table({"doc": [0] * 4000, "id": [i % 2 for i in range(4000)], "group": [0] * 4000})
    want = Counter((x, y) for x in a["id"].to_pylist() for y in (0, 1) for _ in range(2000))
    got = {(r["a"], r["b"]): r["n"] for r in al.links(a, b).to_pylist()}
    assert got == want


def test_awkward_rows_and_empty_tables(spark, awkward):
    docs = awkward.withColumns({"N_A": F.lit("mine"), "n_best": F.lit("mine"), "a": F.lit("mine"), "docs": F.lit("mine"), "_row": F.lit("mine")})
    for max_pairs in (10**9, 0):
        found = al.with_counts(al.staged_alignment(al.align_tokens(docs)), max_pairs)
        assert found.count() == awkward.count()
        assert found.where("a <> 'mine' or docs <> 'mine' or _row <> 'mine'").count() == 0
        assert found.where("(text is null or text = '') and (n_a + n_b + n_groups + n_links + n_best + count_sum <> 0 or groups <> '')").count() == 0
        assert found.where("length(text) > 100000 and n_links > 1000").count() == 1
        assert al.with_counts(al.align_tokens(docs.limit(0)), max_pairs).count() == 0
