import pytest

import __spark_entry__ as contract
import corpus_pipeline
from stratalode.llm import decontaminate, minhash, pii, toxicity
from tests.llm.conftest import CLASHING
from tests.llm.test_near_duplicates import brute_force

BASE = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def tables(spark, tmp_path):
    vocabulary = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(200):
        words = [vocabulary[(i * 37 + k * k * 7 + k) % 200] for k in range(30 + i % 9)]
        if i % 5 == 0:
            words[3:3] = ["vileword", "nastyterm", "grossname"]
        rows.append((i, " ".join(words), "en", f"s{i % 4}", 0))
    rows += [(1000 + i, rows[i][1] + " tail", "en", "s0", 0) for i in (1, 2, 3)]
    rows.append((2001, "before alpha beta gamma delta epsilon zeta eta theta iota kappa lambda after", "en", "s1", 0))
    rows.append((2002, "reach me at a.b@c.example or 10.0.0.1 today", "en", None, 43))
    rows += [(2003, None, None, "s1", None), (2004, "", None, "s2", 0), (None, "no id here", None, None, None)]
    spark.createDataFrame(rows, BASE).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i % 5 == 0)) for i in range(200)]
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), rows


def test_stages_take_effect_and_keep_clean_documents(spark, tables):
    sf_dir, rows = tables
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, apply in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = apply(spark, docs, sf_dir)
        if name != "mixing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        if name == "toxicity":
            assert {i for i in range(200) if i not in kept[name]} == {i for i in range(200) if i % 5 == 0}
        if name == "minhash":
            want = {k for k, *_, stays in brute_force([(k, r["text"]) for k, r in before.items() if k is not None], 5) if stays}
            assert set(kept[name]) == want | {None}
        if name == "decontamination":
            assert set(before) - set(kept[name]) == {2001}
        if name == "pii":
            assert kept[name].keys() == before.keys()
            assert kept[name][2002]["text"] == "reach me at [EMAIL] or [IP] today"
            assert kept[name][2002]["n_chars"] == 33
            assert {k: r for k, r in kept[name].items() if k != 2002} == {k: r for k, r in before.items() if k != 2002}
    assert kept["mixing"].keys() == kept["pii"].keys()
    by_source = {}
    for r in kept["mixing"].values():
        by_source.setdefault(r["source"], []).append(r)
    for own in by_source.values():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.5


def test_the_result_holds_the_redacted_texts_of_the_mix(spark, tables):
    sf_dir, _ = tables
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert all(sum(len(d["text"].split()) for d in r["draws"]) == r["taken"] for r in found.values())
    assert any(r["taken"] for r in found.values())
    for d in found[2002]["draws"]:
        assert d["text"].split() == "reach me at [EMAIL] or [IP] today".split()[d["from_word"] : d["to_word"]]
    assert found[2003]["draws"] == []


def test_run_and_registration(spark, tables):
    sf_dir, _ = tables
    assert contract.queries()["pipeline"](spark, sf_dir).count() == corpus_pipeline.run(spark, sf_dir).count()
    assert corpus_pipeline.ORACLE_SQL is None
    names = contract.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_awkward_and_empty_documents(spark, tables, awkward):
    sf_dir, _ = tables
    for docs in (awkward, awkward.limit(0)):
        for name, apply in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = apply(spark, docs, sf_dir)
            if name != "mixing":
                assert docs.columns == columns
                own = [c for c in CLASHING if c in columns]
                assert own and docs.where(" or ".join(f"`{c}` is distinct from 'mine'" for c in own)).count() == 0
        assert docs.where("doc_id is not null and taken > 2 * size").count() == 0


def test_stages_call_one_operator_each():
    assert {minhash, decontaminate, pii, toxicity} <= {vars(corpus_pipeline)[n] for n in ("minhash", "decontaminate", "pii", "toxicity")}
