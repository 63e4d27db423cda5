"""A stored cohort that takes sheets: read, check, enrich, merge by id, register, verify, as one job.

    root/rows       the keyed table, one row an id
    root/loads      each sheet's enriched rows, a directory a version
    root/versions   what was loaded when, and what it changed
    root/audit      mergeable audit states, a directory a version
    root/snapshots  the distribution after each load

Each step writes the directory or the buckets of its version and replaces what an
earlier attempt left, so a job that failed half way is simply run again. The registry
is written last: a version it lists is loaded completely, and readers ask it which is
current.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators import cleaning, distribution, quality
from cohortloom.operators.audit import AuditStore
from cohortloom.schema import CohortSchema
from cohortloom.sources import files, store
from cohortloom.sources.keyed import KeyedTable

LOAD = "load"


class VersionError(LookupError):
    """The registry does not know the version, or none at all."""


class VerificationError(ValueError):
    """The stored table is not what the load should have made of it."""


@dataclass(frozen=True)
class CohortStore:
    root: str
    schema: CohortSchema
    renames: Mapping[str, str] = field(default_factory=dict)
    """Sheet header -> column. Without any, the sheet has the schema's own names."""
    buckets: int = 64

    @property
    def row_schema(self) -> T.StructType:
        numbers = [T.StructField(name, T.IntegerType()) for name in self.schema.features]
        texts = {name: T.StructField(name, T.StringType()) for name in (self.schema.id, self.schema.label, self.schema.band_name)}
        return T.StructType(
            [
                texts[self.schema.id],
                *numbers,
                texts[self.schema.label],
                texts[self.schema.band_name],
                T.StructField(f"{self.schema.label}_encoded", T.IntegerType()),
                T.StructField("feature_signature", T.StringType()),
                T.StructField("dataset_version", T.StringType()),
                T.StructField("updated_at", T.TimestampNTZType()),
                T.StructField("created_at", T.TimestampNTZType()),
            ]
        )

    @property
    def table(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/rows", self.schema.id, self.row_schema, self.buckets)

    @property
    def audits(self) -> AuditStore:
        return AuditStore(f"{self.root}/audit", self.schema)

    def sheet(self, spark: SparkSession, path: str) -> DataFrame:
        """The sheet's text under canonical names; its columns have to be exactly the expected ones."""
        expected = list(self.renames) or [self.schema.id, *self.schema.features, self.schema.label]
        header = spark.read.option("header", True).csv(path).columns
        rows = files.read_clean(spark, path, files.text_schema(header))
        return cleaning.canonicalize(cleaning.require_columns(rows, expected), self.renames)

    def ingest(
        self, spark: SparkSession, path: str, version: str, now: datetime, limits: Mapping[str, int | None] | None = None
    ) -> dict[str, int]:
        """Load a sheet as `version`; rows, inserted, matched and modified keys.

        An id that repeats in the sheet keeps one row, the largest by all its columns. With
        `limits` the audit gates the load (see `AuditStore.add`); without, whatever is
        invalid is loaded, as missing or with an unknown label, and only counted.
        """
        with files.shuffles_dropped(spark):
            sheet = self.sheet(spark, path)
            lax = {f"invalid_{name}": None for name in (self.schema.number, self.schema.category, self.schema.label)}
            self.audits.add(version, sheet, limits=dict(limits) if limits is not None else {**lax, "invalid_risk_scale": None})
            loads, name = f"{self.root}/loads", F.lit(f"v-{version}")
            enriched = cleaning.enrich(sheet, self.schema, version, now).withColumn(LOAD, name)
            enriched.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD).parquet(loads)
            loaded = spark.read.parquet(loads).where(F.col(LOAD) == name).drop(LOAD)
            counts = self.table.merge(loaded, now, order="updated_at")
            counts["rows"] = loaded.count()
            rows = self.table.read(spark)
            store.append_snapshot(distribution.distribution_table(rows, self.schema), f"{self.root}/snapshots", now)
            self._verify(spark, rows)
            self._register(spark, version, counts, now)
            return counts

    def _verify(self, spark: SparkSession, rows: DataFrame) -> None:
        """Ids unique, signatures whole where no feature is missing, columns complete, no sheet header left."""
        checks = quality.verify(
            rows, self.schema, spark.createDataFrame([], "check_name string, expected bigint"),
            store.latest_snapshot(spark, f"{self.root}/snapshots"), raw_names=[n for n in self.renames if n != self.renames[n]],
        )
        # Counts by label are facts here, not expectations; a missing feature leaves a row unsigned.
        wanted = ("unique_id", "missing_columns", "raw_case_columns", "snapshots")
        failed = checks.where(F.col("check_name").isin(*wanted) & ~F.col("ok")).collect()
        if failed:
            raise VerificationError("; ".join(f"{r.check_name}: {r.measured}, not {r.expected}" for r in failed))

    def _register(self, spark: SparkSession, version: str, counts: Mapping[str, int], now: datetime) -> None:
        entry = spark.range(1).select(
            F.lit(version).alias("version"),
            F.lit(counts["rows"]).cast("bigint").alias("n_rows"),
            *[F.lit(counts[name]).cast("bigint").alias(name) for name in ("inserted", "matched", "modified")],
            cleaning.timestamp(now).alias("created_at"),
            F.lit(f"v-{version}").alias(LOAD),
        )
        entry.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD).parquet(f"{self.root}/versions")

    def versions(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/versions").drop(LOAD)

    def current_version(self, spark: SparkSession) -> str:
        """The version that was registered last."""
        if not files.exists(spark, f"{self.root}/versions"):
            raise VersionError("no version is registered")
        newest = F.max_by("version", F.struct("created_at", "version"))
        return self.versions(spark).agg(newest).first()[0]

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as the current version left it."""
        self.current_version(spark)
        return self.table.read(spark)

    def read_load(self, spark: SparkSession, version: str | None = None) -> DataFrame:
        """The enriched rows of one load, the current one unless named; no other load is read."""
        version = version or self.current_version(spark)
        if self.versions(spark).where(F.col("version") == version).isEmpty():
            raise VersionError(f"no such version: {version}")
        return spark.read.parquet(f"{self.root}/loads").where(F.col(LOAD) == f"v-{version}").drop(LOAD)
