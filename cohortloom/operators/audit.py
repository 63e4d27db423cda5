"""Audits that add up: every batch leaves a state, and states merge into the audit of all rows.

The state of a batch is three small tables: one row of counters, its distinct ids, and
its distinct rows as digests with their counts. Sums add, distinct values unite, so a
new batch is audited at the cost of the batch, and the audit of everything loaded so far
reads states and no rows. Each batch has its own directory, which a repeated load replaces.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators import quality
from cohortloom.schema import CohortSchema

BATCH = "batch"


@dataclass(frozen=True)
class AuditStore:
    root: str
    schema: CohortSchema

    def _path(self, part: str) -> str:
        return f"{self.root.rstrip('/')}/{part}"

    def _replace(self, rows: DataFrame, part: str, batch: str) -> None:
        named = rows.withColumn(BATCH, F.lit(f"b-{batch}"))
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(self._path(part))

    def add(self, batch: str, rows: DataFrame, write: Callable[[DataFrame], None] | None = None, limits: dict[str, int] | None = None) -> None:
        """Gate a batch, write it, and keep its state.

        The counters come first. Where one of them exceeds its limit (0 for every
        `invalid_*` counter unless given; None lets any number pass), `QualityError` names
        it, nothing is written and no state is kept. Then `write` takes the rows.
        """
        counted = quality.counters(rows, self.schema)
        found = counted.first().asDict()
        allowed = {name: 0 for name in found if name.startswith("invalid_")} | (limits or {})
        failed = {name: found[name] for name, most in allowed.items() if most is not None and found[name] > most}
        if failed:
            raise quality.QualityError(", ".join(f"{name}={n}" for name, n in failed.items()))
        if write is not None:
            write(rows)
        spark = rows.sparkSession
        self._replace(spark.createDataFrame([tuple(found.values())], counted.schema), "counters", batch)
        self._replace(rows.select(F.col(self.schema.id).alias("id")).distinct(), "ids", batch)
        self._replace(quality.digests(rows, self.schema), "digests", batch)

    def _read(self, spark: SparkSession, part: str) -> DataFrame:
        return spark.read.parquet(self._path(part)).drop(BATCH)

    def summary(self, spark: SparkSession) -> DataFrame:
        """`quality_summary` of the rows of all batches, from their states."""
        sums = self._read(spark, "counters")
        sums = sums.agg(*[F.sum(name).alias(name) for name in sums.columns])
        ids = self._read(spark, "ids").agg(
            F.count_distinct("id").alias("distinct_ids"),
            F.coalesce(F.max(F.col("id").isNull().cast("int")), F.lit(0)).alias("null_id"),
        )
        rows = self._read(spark, "digests").groupBy("signature", "stated", "row_key").agg(F.sum("n").alias("n"))
        return quality.summary_of(self.schema, sums, ids, quality.summarize_digests(rows))

    def compact(self, spark: SparkSession, batch: str, path: str) -> AuditStore:
        """A new store at `path` with all states merged into one batch: what to go on with after many."""
        merged = AuditStore(path, self.schema)
        sums = self._read(spark, "counters")
        merged._replace(sums.agg(*[F.sum(name).alias(name) for name in sums.columns]), "counters", batch)
        merged._replace(self._read(spark, "ids").distinct(), "ids", batch)
        rows = self._read(spark, "digests").groupBy("signature", "stated", "row_key").agg(F.sum("n").alias("n"))
        merged._replace(rows, "digests", batch)
        return merged
