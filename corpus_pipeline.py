"""The training-data pipeline over `documents`: each stage is written as Parquet and reread by the next.

Defined cases: null and blank texts are documents like others. The classifier scores them
as it scores any; they link with nothing, hold no item and no personal data, and pack as
their end mark alone. Rows with a null id are never taken for copies of others and stay;
rows that share an id stay or go together. Of equal documents the one with the smallest
id stays. Other columns pass through to the last stage, which returns pieces. An empty
table gives empty stages; without labelled documents every score is that of an unfitted
field.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import crf, decontamination, jaccard, packing, pii
from cohortloom.llm.common import table
from cohortloom.llm.labelled import training_rows
from cohortloom.sources.files import scratch_dir

TOKENIZER = "word_bpe_49k.json"
SAMPLE = 4000  # labelled documents that the classifier is fitted on
KEPT = 0.7  # quality score from which a document stays


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores as good; the same fold as in the quality query is never learned from."""
    field = crf.fit(training_rows(docs, table(spark, sf_dir, "labels"), "quality", 4, 2, SAMPLE))
    return docs.filter(crf.score(field) >= KEPT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 over five-word shingles."""
    return jaccard.representatives(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, edited or not."""
    return decontamination.without_matches(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by the kind in brackets."""
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Concatenate and cut everything that is left into sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", redact),
    ("packing", pack),
]

# Trained models and Smith-Waterman alignment are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), scratch_dir(spark)
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
