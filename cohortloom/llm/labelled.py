"""Training rows for the classifiers: a bounded sample of labelled documents outside the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import text_of


def held_out(id_col: str, modulus: int, fold: int) -> Column:
    """Whether a document is in the held-out fold; a null id never is."""
    remainder = F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(modulus))
    return F.coalesce(remainder == fold, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, label_col: str, modulus: int, fold: int, sample: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, text, label) of at most `sample` labelled documents outside the fold, in the order of a hash of the id.

    An id labelled more than once counts as its highest label; of documents that share an
    id one is taken, by a hash of its text, so `sample` bounds the rows too.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col, modulus, fold))
    one = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    chosen = one.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    found = rows.join(F.broadcast(chosen), "id")  # `sample` rows at most
    first = F.min_by(F.struct("text", "label"), F.struct(F.xxhash64("text"), "text")).alias("one")
    return found.groupBy("id").agg(first).select("id", "one.text", "one.label")
