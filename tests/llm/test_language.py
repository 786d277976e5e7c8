import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from stratalode.llm.language import ORDER, LanguageModel, fit_languages, identify_languages, kneser_ney, read_text
from stratalode.llm.words import utf8

SOUNDS = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "ung", "ber"], "cc": ["ción", "ez", "ña", "ado"]}


def sentence(rng, lang, n=12):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n)).capitalize() + "."


def corpus(spark, n=240):
    rng = random.Random(3)
    rows = [(i, sentence(rng, lang), lang) for i in range(n) for lang in [sorted(SOUNDS)[i % 3]]]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_held_out_accuracy_and_rejection(spark):
    docs = corpus(spark)
    model = fit_languages(docs.where("doc_id % 4 <> 2"), max_per_language=50)
    assert model.languages == ("aa", "bb", "cc")
    found = identify_languages(docs.where("doc_id % 4 = 2"), model)
    assert found.where("lang_best <> lang").count() == 0
    assert found.where("lang_score < 0.5 or lang_score > 1").count() == 0
    other = spark.createDataFrame([(1, "xqzvw wxyzq pfghj " * 5), (2, "123 ... 456"), (3, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["lang_best"], r["lang_score"], r["lang_rejected"]) for r in identify_languages(other, model).collect()}
    assert got[1][2] and got[2] == ("und", 0.0, True) and got[3] == ("und", 0.0, True)


def test_probabilities_add_up_to_one():
    data, at = utf8(pa.array(["abracadabra abba cadabra", "Äbrä cä"]))
    packed, _ = read_text(data, at).grams()
    keys, counts = np.unique(packed, return_counts=True)
    model = kneser_ney(keys, counts)
    for context in ("abr", "zzz", "ra "):
        head = np.uint64(0)
        for c in context[-(ORDER - 1) :]:
            head = (head << np.uint64(16)) | np.uint64(ord(c))
        every = (head << np.uint64(16)) | np.arange(0x10000, dtype=np.uint64)
        assert abs((2.0 ** -model.log2(every)).sum() - 1) < 1e-9


def test_rows_do_not_depend_on_their_neighbours(spark):
    docs = corpus(spark, 60)
    model = fit_languages(docs)
    alone = [identify_languages(docs.where(f"doc_id = {i}"), model).first()["lang_bits"] for i in (3, 4)]
    together = {r["doc_id"]: r["lang_bits"] for r in identify_languages(docs.coalesce(1), model).collect()}
    assert np.allclose(alone, [together[3], together[4]])


def test_awkward_rows_and_empty_tables(spark, awkward):
    model = fit_languages(awkward)
    found = identify_languages(awkward, model)
    assert found.count() == awkward.count()
    best = {r["doc_id"]: r["lang_best"] for r in found.where("doc_id is not null").collect()}
    assert best[3] == best[4] == best[5] == best[7] == "und"
    none = fit_languages(awkward.limit(0))
    assert none.languages == ()
    assert {r["lang_best"] for r in identify_languages(awkward, none).collect()} == {"und"}
    assert identify_languages(awkward.limit(0), model).count() == 0


def plain_codes(text):
    """A text as the model reads it: three edges, then lower-case letters with one space for each run of others."""
    out = ["\x01"] * 3
    for i, char in enumerate(text):
        char = char.lower()[0] if char.isalpha() else " "
        if char != " " or i == 0 or out[-1] != " ":
            out.append(char)
    return "".join(out)


def plain_kneser_ney(texts):
    """Interpolated Kneser-Ney with dictionaries, straight from the formula; a function of history and character."""
    top = Counter(s[i - 3 : i + 1] for s in map(plain_codes, texts) for i in range(3, len(s)))
    counts = {4: top}
    for order in (3, 2, 1):
        counts[order] = Counter(gram[1:] for gram in counts[order + 1])
    discounts = {}
    for order in (4, 3, 2):
        once, twice = (sum(n == k for n in counts[order].values()) for k in (1, 2))
        discounts[order] = once / (once + 2 * twice) if once else 0.5

    def probability(history, char, order=4):
        if order == 1:
            return 0.1 / 65536 + 0.9 * counts[1][char] / sum(counts[1].values())
        context = history[len(history) - order + 1 :]
        after = {gram: n for gram, n in counts[order].items() if gram[:-1] == context}
        lower = probability(history, char, order - 1)
        if not after:
            return lower
        total = sum(after.values())
        own = max(after.get(context + char, 0) - discounts[order], 0) / total
        return own + discounts[order] * len(after) / total * lower

    return probability


def test_bits_equal_a_plain_version():
    rng = random.Random(11)
    letters = "aaabbcdé ñ.,1Я"
    for _ in range(12):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(rng.randrange(1, 8))]
        asked = [*texts[:2], "".join(rng.choice(letters + "xyz") for _ in range(40)), "zzz", "  a"]
        keys, counts = np.unique(read_text(*utf8(pa.array(texts))).grams()[0], return_counts=True)
        model = LanguageModel(("x",), (kneser_ney(keys, counts),))
        bits = model.bits(read_text(*utf8(pa.array(asked))))[:, 0]
        probability = plain_kneser_ney(texts)
        for text, got in zip(asked, bits, strict=True):
            s = plain_codes(text)
            each = [-math.log2(probability(s[i - 3 : i], s[i])) for i in range(3, len(s))]
            assert abs(got - sum(each) / len(each)) < 1e-9
