"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cohortloom.llm import (
    centroids, crf, decontamination, jaccard, licenses, packing, pii, secrets, templates, toxicity, variants, warc, winnowing,
)
from cohortloom.llm.common import table
from cohortloom.llm.labelled import held_out, training_rows
from cohortloom.llm.oracles import ORACLES  # noqa: F401 - read by the entry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

TOKENIZER = "word_bpe_49k.json"
SAMPLE = 4000  # labelled documents that a classifier is fitted on
KEPT = 0.7  # score from which label 1 is predicted


def predictions(docs: DataFrame, score: Column, held: Column) -> DataFrame:
    scored = docs.select("doc_id", held.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= KEPT).cast("int"))


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op8_concat_pack(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packing.piece_digest(pieces)


@query
def op2_pii_boosting(spark, sf_dir):
    return pii.digest(pii.detect(table(spark, sf_dir, "documents")))


@query
def op7_linked_secrets(spark, sf_dir):
    return secrets.digest(secrets.detect(table(spark, sf_dir, "documents")))


@query
def op9_winnowing(spark, sf_dir):
    return winnowing.compare(table(spark, sf_dir, "documents"))


@query
def op5_warc_revisits(spark, sf_dir):
    heads = warc.deduplicate(table(spark, sf_dir, "pages"))
    return heads.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op6_decontamination(spark, sf_dir):
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_quality_crf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    field = crf.fit(training_rows(docs, table(spark, sf_dir, "labels"), "quality", 4, 2, SAMPLE))
    return predictions(docs, crf.score(field), held_out("doc_id", 4, 2))


@query
def op3_toxicity_automata(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(training_rows(docs, table(spark, sf_dir, "labels"), "toxic", 3, 1, 2 * SAMPLE))
    return predictions(docs, toxicity.score(model), held_out("doc_id", 3, 1))


@query
def op10_template_extraction(spark, sf_dir):
    return templates.extract(table(spark, sf_dir, "pages"))


@query
def op4_jaccard_regions(spark, sf_dir):
    return jaccard.classes(table(spark, sf_dir, "documents"), k=4, percent=85)


@query
def op11_trie_pairs(spark, sf_dir):
    return variants.group(variants.counted_words(table(spark, sf_dir, "documents")))


@query
def op12_rotated_centroids(spark, sf_dir):
    clusters, found = centroids.fit(table(spark, sf_dir, "embeddings"))
    return centroids.with_inertia(clusters, found)


@query
def op13_license_index(spark, sf_dir):
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
