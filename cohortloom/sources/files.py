"""CSV, count files, Parquet manifests and exports."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions import match_label, strip
from cohortloom.schema import CohortSchema


class EmptyExportError(ValueError):
    """No row matches the export filter."""


def scratch_dir(spark: SparkSession) -> str:
    """A fresh directory under the folder that driver and executors share.

    That is `spark.checkpoint.dir`; where the session names none, the warehouse,
    which every cluster that stores tables shares.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/cohortloom-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, wherever Spark's readers reach."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own scratch output."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, what a job has shuffled is deleted when the job ends, not when the driver happens to collect garbage.

    For jobs whose frames run once, as those that store them. Run again, they shuffle again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column, from the names of the directories alone."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [status.getPath().getName() for status in place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(place)]
    return [name.split("=", 1)[1] for name in names if name.startswith(f"{column}=")]


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_clean(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, typed by the given schema. A leading BOM is dropped.

    No inference: it reads the file twice, and a column guessed as double would
    change every signature. The header has to agree with the schema.
    """
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def _positional(spark: SparkSession, path: str, columns: Sequence[str], labels: Sequence[str]) -> tuple[DataFrame, Column]:
    """(lines that are no header, whether a line is broken)."""
    schema = text_schema(columns).add("_bad_line", T.StringType())
    lines = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        # A pruned parse does not see how many fields a line has.
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", "_bad_line")
        .csv(path)
    )
    first, last = columns[0], columns[-1]
    # A byte order mark in the middle of a directory's files survives the reader.
    is_header = F.coalesce(F.ltrim(F.col(first), F.lit("\ufeff")) == first, F.lit(False)) | F.coalesce(
        F.col(last) == last, F.lit(False)
    )
    broken = F.col("_bad_line").isNotNull()
    if labels:
        broken = broken | match_label(F.col(last), labels).isNull()
    return lines.where(~is_header), broken


def read_positional(
    spark: SparkSession, path: str, columns: Sequence[str], labels: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(rows, one row with `bad_rows`) of CSV text read by position.

    Blank lines and header lines, wherever in a file they stand, are skipped;
    lines with too few or too many fields are counted and left out. With declared
    `labels`, so are lines whose last field is none of them. Whoever needs both results
    reads the text once with `load_positional`.
    """
    body, broken = _positional(spark, path, columns, labels)
    return body.where(~broken).select(*columns), body.agg(F.count_if(broken).alias("bad_rows"))


def load_positional(
    spark: SparkSession, path: str, columns: Sequence[str], target: str, labels: Sequence[str] = ()
) -> tuple[DataFrame, int]:
    """(rows stored at `target`, number of broken lines), as `read_positional` has them.

    The broken lines are counted on the way, while the rows are written: one scan, one parse.
    """
    body, broken = _positional(spark, path, columns, labels)
    seen = Observation()
    rows = body.observe(seen, F.count_if(broken).alias("bad_rows")).where(~broken).select(*columns)
    rows.write.parquet(target)
    return spark.read.schema(rows.schema).parquet(target), seen.get["bad_rows"]


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(section, key, n) of `key<TAB>count` lines.

    The section is the key up to its first '|'. The count is everything after the
    first tab; lines where that is not a whole number are dropped. If a key repeats, its last line wins.
    """
    lines = spark.read.text(path).select(
        F.regexp_replace(F.col("value"), "^\ufeff", "").alias("line"),
        F.struct(
            "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at")
        ).alias("place"),
    )
    value = strip(F.expr("substring(line, locate('\t', line) + 1)"))
    parsed = lines.where(F.col("line").contains("\t")).select(
        F.substring_index("line", "\t", 1).alias("key"),
        F.when(value.rlike(r"^[+-]?[0-9]+$"), value.try_cast("bigint")).alias("n"),
        "place",
    )
    last = parsed.where(F.col("n").isNotNull()).groupBy("key").agg(F.max_by("n", "place").alias("n"))
    return last.select(F.substring_index("key", "|", 1).alias("section"), "key", "n")


def write_counts(distribution: DataFrame, path: str) -> None:
    """(key, n) as `key<TAB>count` text."""
    distribution.select("key", "n").write.mode("errorifexists").option("sep", "\t").csv(path)


def write_searchable(
    rows: DataFrame, path: str, schema: CohortSchema, files: int = 8, group_bytes: int = 8 << 20
) -> None:
    """Rows as Parquet that filters can skip through.

    Rows are ranged by label, number and id over `files` files, so a label that most rows
    have is spread too, and sorted within: filters on label and number skip row groups
    by their bounds. Ids stand in no order; each row group has a Bloom filter of its ids,
    sized for as many as `group_bytes` may hold.
    """
    order = [schema.label, schema.number, schema.id]
    per_group = max(1000, group_bytes // (8 * len(rows.columns)))
    (
        rows.repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .write.option("parquet.block.size", group_bytes)
        .option(f"parquet.bloom.filter.enabled#{schema.id}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{schema.id}", per_group)
        # Repeated ids would be met by a dictionary; unique ones only bloat it.
        .option(f"parquet.enable.dictionary#{schema.id}", "false")
        .parquet(path)
    )


def write_manifest(split: DataFrame, path: str, dealt: bool = False) -> None:
    """Split rows as Parquet, one directory per side so a side can be read alone.

    The rows are dealt out evenly, because a fit reads them many times over; those that
    are `dealt` out already stay where they are.
    """
    parts = int(split.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (split if dealt else split.repartition(parts)).write.mode("errorifexists").partitionBy("split").parquet(path)


def read_manifest(spark: SparkSession, path: str, side: str | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows if side is None else rows.where(F.col("split") == side)


def write_outputs(counting: DataFrame, model: DataFrame, report: DataFrame, path: str) -> dict[str, str]:
    """The two published frames as CSV and Parquet, the quality report as CSV.

    The text form is made from the stored Parquet, so cleaning runs once a frame.
    """
    places = {}
    spark = counting.sparkSession
    for name, frame in (("counting", counting), ("model", model)):
        places[f"{name}_csv"] = f"{path}/{name}_csv"
        places[f"{name}_parquet"] = f"{path}/{name}_parquet"
        frame.write.parquet(places[f"{name}_parquet"])
        stored = spark.read.schema(frame.schema).parquet(places[f"{name}_parquet"])
        stored.write.option("header", True).csv(places[f"{name}_csv"])
    places["report_csv"] = f"{path}/report_csv"
    report.write.option("header", True).csv(places["report_csv"])
    return places


def write_export(rows: DataFrame, path: str) -> None:
    """An export as CSV part files with headers; an empty one raises."""
    if rows.isEmpty():
        raise EmptyExportError("no row matches the filter")
    rows.write.option("header", True).csv(path)
