"""From raw documents to a training mix: five stages, each of one operator.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.
All but the last return the columns of ``documents``. NULL and empty texts pass
the filtering stages; an empty table passes all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalode.llm import decontaminate, minhash, mixing, pii, toxicity
from stratalode.llm.columns import sparing
from stratalode.sinks import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of less than a half; learnt from four fifths of the labels."""
    labels = _table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = toxicity.fit_toxicity(docs, labels)
    return sparing(docs, toxicity.FIELDS, lambda rows: toxicity.score_toxicity(rows, model).where("toxicity < 0.5"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id; five-word shingles, 0.8."""
    return minhash.keep_one(docs, minhash.near_duplicates(docs, shingle_words=5, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten consecutive words of a benchmark item."""
    return decontaminate.keep_clean(docs, _table(spark, sf_dir, "benchmark"), n=10)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; n_chars follows the text."""
    model = pii.fit_pii(docs)

    def redacted(rows: DataFrame) -> DataFrame:
        found = pii.redact(rows, model)
        if "n_chars" not in docs.columns:
            return found
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        return found.withColumn("n_chars", F.when(F.size("pii") > 0, n_chars).otherwise(F.col("n_chars")))

    return sparing(docs, pii.FIELDS, redacted)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: one row per document, its draws with shard, pass, words and text."""
    mixed = mixing.mix(docs, with_text=True)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", "draws")


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("mixing", mix_sources),
]

# The toxicity model and the field for personal data have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
