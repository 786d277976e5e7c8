import hashlib
import re

from stratalode.llm.decontaminate import cut_spans, find_contamination, items_digest, keep_clean

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(text, items, n):
    own, hit, found = words(text), set(), set()
    for item, body in items:
        other = words(body)
        size = min(n, len(other))
        for w in range(len(other) - size + 1) if other else ():
            for i in range(len(own) - size + 1):
                if own[i : i + size] == other[w : w + size]:
                    hit |= set(range(i, i + size))
                    found |= {str(item)} if item is not None else set()
    return len(own), len(hit), sorted(found)


ITEMS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, "short item"), (10, "Zwölf Boxkämpfer, jagen!"), (3, None), (4, ""), (5, "-- !"), (None, "nameless one"), (2, "short item"),
]
TEXTS = [
    "x alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu y",
    "ALPHA, beta; gamma-delta epsilon zeta eta theta iota KAPPA nu", "alpha beta gamma delta epsilon zeta eta theta iota",
    "a short item here, another Short Item there", "zwölf boxkämpfer jagen", "zwölfboxkämpfer jagen", None, "", "   ",
    "nameless one", "kappa lambda mu " + "filler " * 20_000 + "beta gamma delta epsilon zeta eta theta iota kappa lambda",
]


def test_agrees_with_brute_force_by_broadcast_and_by_join(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(0, TEXTS[0])], "doc_id bigint, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    want = sorted([(i, *brute_force(t, ITEMS, 10)) for i, t in enumerate(TEXTS)] + [(0, *brute_force(TEXTS[0], ITEMS, 10))])
    for limit in (1 << 20, 0):
        found = find_contamination(docs, items, 10, max_benchmark_bytes=limit)
        got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect())
        assert got == want
    digest = {r["doc_id"]: r["d"] for r in found.select("doc_id", items_digest().alias("d")).collect()}
    assert digest[3] == hashlib.sha256(b"2").hexdigest()
    assert digest[7] == hashlib.sha256(b"").hexdigest()


def test_spans_are_cut_and_documents_dropped(spark):
    docs = spark.createDataFrame([(1, "é a short item, ok short item"), (2, "fine"), (3, None)], "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    cut = {r["doc_id"]: r["text"] for r in cut_spans(find_contamination(docs, items)).collect()}
    assert cut == {1: "é a , ok ", 2: "fine", 3: None}
    assert sorted(r["doc_id"] for r in keep_clean(docs, items).collect()) == [2, 3]


def test_awkward_rows_and_empty_tables(spark, awkward):
    items = spark.createDataFrame([(7, "jumps over the lazy dog")], "item_id bigint, text string")
    found = find_contamination(awkward, items)
    assert found.count() == awkward.count()
    assert {r["doc_id"] for r in found.where("n_hit > 0").collect()} == {1, 2, 10, None}
    assert keep_clean(awkward, items).columns == awkward.columns
    assert find_contamination(awkward.limit(0), items).count() == 0
    assert find_contamination(awkward, items.limit(0)).where("n_hit > 0").count() == 0
    assert find_contamination(awkward, items.limit(0), max_benchmark_bytes=-1).where("n_hit > 0").count() == 0


def test_join_and_broadcast_agree_in_all_columns(spark, rows):
    texts = [*TEXTS, "é\U0001f600 a short item, ok short item", "\U0001f600, nameless-one nameless"]
    data = [(i, t, "mine") for i, t in enumerate(texts)] + [(0, TEXTS[0], "mine")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, HIT_spans string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for bench in (items, items.limit(0)):
        sent, joined = (find_contamination(docs, bench, 10, max_benchmark_bytes=limit) for limit in (1 << 20, -1))
        assert sent.schema == joined.schema
        assert rows(sent) == rows(joined)
        assert rows(cut_spans(sent)) == rows(cut_spans(joined))
    cut = {r["doc_id"]: r["text"] for r in cut_spans(find_contamination(docs, items, max_benchmark_bytes=0)).collect()}
    assert cut[len(TEXTS)] == "é\U0001f600 a , ok " and cut[len(TEXTS) + 1] == "\U0001f600,  nameless"
