"""A stored table that takes batches by key, at the cost of the keys' buckets.

Rows are kept in directories by a hash of their key. A batch names the buckets that it
touches; those are read, merged and replaced by a dynamic partition overwrite, all other
directories stay as they are. The merged buckets are written to a scratch folder first,
so a job that fails while it computes leaves the table untouched, and one that fails
while it replaces can be repeated with the same batch and gives the same table.

A null key is a key like any other: its rows of a batch are one row afterwards, found
again by the next batch. With `null_keys="refuse"` such a batch fails and names the count.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.sources.files import exists, remove, scratch_dir, shuffles_dropped
from cohortloom.sources.store import changes, dedupe_batch, merged_rows

BUCKET = "_bucket"


class KeyedTableError(ValueError):
    """A batch holds rows without a key, or the table is laid out otherwise."""


@dataclass(frozen=True)
class KeyedTable:
    root: str
    key: str
    schema: T.StructType
    """Columns of a row, `created_at` included."""
    buckets: int = 64
    """Chosen once: about the table's size over that of a handy file."""
    null_keys: str = "keep"

    @property
    def path(self) -> str:
        # Another number of buckets is another place, never a mixture.
        return f"{self.root.rstrip('/')}/by={self.key}-{self.buckets}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast(self.schema[self.key].dataType)), F.lit(self.buckets)).cast("int")

    def _stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])

    def _rows(self, spark: SparkSession) -> DataFrame:
        """All rows with their bucket; an absent table has none."""
        if not exists(spark, self.path):
            return spark.createDataFrame([], self._stored_schema())
        return spark.read.schema(self._stored_schema()).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark).select(*self.schema.names)

    def lookup(self, spark: SparkSession, value) -> DataFrame:
        """Rows of one key; only its bucket is read."""
        literal = F.lit(value).cast(self.schema[self.key].dataType)
        # A number, not an expression, so that the directory is chosen before the scan.
        number = spark.range(1).select(literal.alias(self.key)).select(self.bucket()).first()[0]
        found = self._rows(spark).where((F.col(BUCKET) == number) & F.col(self.key).eqNullSafe(literal))
        return found.select(*self.schema.names)

    def merge(self, batch: DataFrame, now: datetime, order: str | None = None) -> dict[str, int]:
        """Take a batch in; (total, inserted, matched, modified) of its keys.

        The counts are observed while the merged buckets are written, so the batch and
        its buckets are read once.
        """
        spark = batch.sparkSession
        place = scratch_dir(spark)
        fields = [name for name in self.schema.names if name != "created_at"]
        absent = [name for name in fields if name not in batch.columns]
        if absent:
            raise KeyedTableError(f"the batch lacks columns: {absent}")
        typed = batch.select(*[F.col(f"`{name}`").cast(self.schema[name].dataType).alias(name) for name in fields])
        if self.null_keys == "refuse":
            without = typed.where(F.col(self.key).isNull()).count()
            if without:
                raise KeyedTableError(f"{without} rows of the batch have no {self.key}")
        with shuffles_dropped(spark):
            counts = self._replace(spark, typed, place, now, order)
        remove(spark, place)
        return counts

    def _replace(self, spark: SparkSession, typed: DataFrame, place: str, now: datetime, order: str | None) -> dict[str, int]:
        fields = typed.columns
        once = dedupe_batch(typed, self.key, order).withColumn(BUCKET, self.bucket())
        once.write.option("compression", "zstd").parquet(f"{place}/batch")
        fresh = spark.read.parquet(f"{place}/batch")
        touched = [row[0] for row in fresh.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
        if not touched:
            return {"total": 0, "inserted": 0, "matched": 0, "modified": 0}
        current = self._rows(spark).where(F.col(BUCKET).isin(touched))
        facts = Observation()
        merged = merged_rows(current, fresh, self.key, fields, now, [BUCKET]).observe(facts, *changes())
        # Stored as the join leaves them: dealt out by bucket once, when they replace the table's.
        merged.select(*self.schema.names, BUCKET).write.option("compression", "zstd").parquet(f"{place}/merged")
        remove(spark, f"{place}/batch")
        # One bucket goes to one file or a few, not to one from every task.
        ready = spark.read.schema(self._stored_schema()).parquet(f"{place}/merged").repartition(BUCKET)
        stored = ready.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
        stored.partitionBy(BUCKET).parquet(self.path)
        return {name: int(value or 0) for name, value in facts.get.items()}
