import os
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", ""):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, environment.get("PYTHONPATH")]))


PROSE = "The quick brown fox jumps over the lazy dog while seven wizards quietly boil strong magic jugs near the old stone bridge."
LONG = " ".join(f"word{i} goes" for i in range(40_000))
CLASHING = (
    "n_words", "N_HIT", "items", "hit_spans", "pii", "toxicity", "toxic_passages", "lang_best", "lang_score", "size", "target",
    "draws", "taken", "key", "at", "id", "node", "component_id", "kept", "label", "band", "same", "start", "bucket", "worth",
)


@pytest.fixture
def awkward(spark):
    """Documents with NULLs in every column, empty and long texts, repeated rows and clashing columns."""
    rows = [
        (1, PROSE, "en", "b", 1), (1, PROSE, "en", "b", 1), (2, PROSE.upper(), "en", "a", 2), (3, None, "en", "a", None),
        (4, "", None, None, 0), (5, " \t\n ", "fr", "b", 4), (6, LONG, "en", "b", len(LONG)), (None, PROSE, "en", "a", 1),
        (None, None, None, None, None), (7, "...", "de", "c", 3), (8, "ß é 漢字 \U0001f600 x@y.example 10.0.0.1", "de", None, 9),
        (9, "one", "en", "c", 3), (10, PROSE + " And then some more.", "en", "d", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name in CLASHING:
        docs = docs.selectExpr("*", f"'mine' AS `{name}`")
    return docs.repartition(3)
