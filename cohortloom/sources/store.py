"""A keyed table on Parquet: merge, version registry, snapshots, prediction log.

Parquet has no update, so a merge produces the next state of the table and the
caller writes it next to the old one. The version registry says which is current.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.cleaning import timestamp
from cohortloom.sources.files import partition_values, remove, scratch_dir, shuffles_dropped


def dedupe_batch(batch: DataFrame, key: str, order: str | None) -> DataFrame:
    """One row per key.

    With an order column the largest wins, ties go to the larger row. Without
    one, a repeated key fails the job: there is no telling which row is newer.
    Both are combinable aggregates, so a key repeated in a third of the batch
    reaches its reducer as one row per task.
    """
    others = [name for name in batch.columns if name not in (key, order)]
    lead = [order] if order else []
    row = F.struct(*lead, *others)
    winner = F.max(row) if order else F.first(row)
    grouped = batch.groupBy(key).agg(winner.alias("row"), F.count(F.lit(1)).alias("copies"))
    if order is None:
        message = F.concat(F.lit("key repeats in the batch: "), F.col(key).cast("string"))
        grouped = grouped.where(F.when(F.col("copies") > 1, F.raise_error(message).cast("boolean")).otherwise(True))
    return grouped.select(key, *[F.col(f"row.{name}").alias(name) for name in (*lead, *others)])


def merged_rows(
    target: DataFrame, fresh: DataFrame, key: str, fields: Sequence[str], now: datetime, along: Sequence[str] = (),
    how: str = "full_outer",
) -> DataFrame:
    """Target and a deduplicated batch joined null-safely by key: the rows afterwards, and
    for each `_arrived` (in the batch), `_found` (in the target) and `_same` (no field differs).

    Each side marks its rows with a literal, so a null key says nothing about presence.
    Columns `along` belong to the key and are equal on both sides wherever it is.
    """
    old = target.withColumn("_old", F.lit(True))
    others = [name for name in fields if name != key]
    new = fresh.select(
        F.lit(True).alias("_new"),
        *[F.col(name).alias(f"_{name}") for name in (key, *along)],
        *[F.col(name).alias(f"_{name}_new") for name in others],
    )
    condition = F.col(key).eqNullSafe(F.col(f"_{key}"))
    for name in along:
        condition = condition & (F.col(name) == F.col(f"_{name}"))
    joined = old.join(new, condition, how)
    arrived, found = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    same = F.lit(True)
    for name in others:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}_new"))
    return joined.select(
        *[F.when(arrived, F.col(f"_{name}")).otherwise(F.col(name)).alias(name) for name in (key, *along)],
        *[F.when(arrived, F.col(f"_{name}_new")).otherwise(F.col(name)).alias(name) for name in others],
        F.when(found, F.col("created_at")).otherwise(timestamp(now)).alias("created_at"),
        arrived.alias("_arrived"),
        found.alias("_found"),
        same.alias("_same"),
    )


def changes() -> list[Column]:
    """Aggregates over `merged_rows`: total, inserted, matched and modified keys of the batch."""
    arrived, found = F.col("_arrived"), F.col("_found")
    return [
        F.count_if(arrived).alias("total"),
        F.count_if(arrived & ~found).alias("inserted"),
        F.count_if(arrived & found).alias("matched"),
        F.count_if(arrived & found & ~F.col("_same")).alias("modified"),
    ]


def merge_by_key(
    target: DataFrame, batch: DataFrame, key: str, now: datetime, order: str | None = None
) -> DataFrame:
    """The table after the batch: matched rows take all batch fields, new keys are
    added, `created_at` stays that of the first insert. A null key is a key as any other.

    Keys are unique on both sides of the join, so no key can be hot.
    """
    fields = [name for name in target.columns if name != "created_at"]
    return merged_rows(target, dedupe_batch(batch, key, order), key, fields, now).select(*target.columns)


def merge_counts(target: DataFrame, batch: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row: total, inserted, matched and modified keys of a batch.

    Modified means that at least one field would change.
    """
    fields = [name for name in target.columns if name != "created_at"]
    fresh = dedupe_batch(batch, key, order)
    return merged_rows(target, fresh, key, fields, datetime.min, how="right_outer").agg(*changes())


def put_result(results: DataFrame, name: str, document: DataFrame, now: datetime) -> DataFrame:
    """Replace or add one named result of any number of rows.

    All rows of the name are replaced; `created_at` stays that of its first insert.
    """
    named = document.select(F.lit(name).alias("name"), "*")
    first = results.where(F.col("name") == name).groupBy("name").agg(F.min("created_at").alias("_first"))
    dated = named.join(first, "name", "left").withColumn("created_at", F.coalesce("_first", timestamp(now))).drop("_first")
    others = results.where(~F.col("name").eqNullSafe(F.lit(name)))
    return others.unionByName(dated.select(*results.columns))


def register_version(registry: DataFrame, version: str, rows: DataFrame, now: datetime) -> DataFrame:
    """The registry with `version` set to the row count of a dataset.

    A version that is loaded again takes the new count and time.
    """
    entry = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(version).alias("version"), "n_rows", timestamp(now).alias("created_at")
    )
    kept = registry.where(F.col("version") != version).select("version", "n_rows", "created_at")
    return kept.unionByName(entry)


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "version string, n_rows bigint, created_at timestamp_ntz")


def write_version(table: DataFrame, root: str, version: str) -> str:
    """Write the next state beside the others; readers keep the one they have."""
    path = f"{root.rstrip('/')}/version={version}"
    table.write.mode("errorifexists").parquet(path)
    return path


def read_version(spark: SparkSession, root: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/version={version}")


def snapshot_rows(distribution: DataFrame, now: datetime) -> DataFrame:
    """(created_at, section, key, n): a distribution snapshot in long form."""
    return distribution.select(
        timestamp(now).alias("created_at"),
        F.substring_index("key", "|", 1).alias("section"),
        "key",
        "n",
    )


TAKEN = "taken"
PART = "part"


def append_snapshot(distribution: DataFrame, path: str, now: datetime) -> None:
    """Keep a snapshot in the directory of its time; taken again, it replaces itself."""
    rows = snapshot_rows(distribution, now).withColumn(TAKEN, F.lit(f"at-{now:%Y-%m-%dT%H-%M-%S.%f}"))
    _replace_parts(rows, path, TAKEN)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(TAKEN)


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot, all its rows; no other is read.

    Which one that is, the names of the directories say.
    """
    newest = max(partition_values(spark, path, TAKEN), default=None)
    return spark.read.parquet(path).where(F.col(TAKEN) == newest).drop(TAKEN)


def _replace_parts(rows: DataFrame, path: str, column: str) -> None:
    stored = rows.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
    stored.partitionBy(column).parquet(path)


MARKS = 1 << 24  # bits that tell most ids that do not repeat from those that do, whatever their number


def _once(rows: DataFrame, key: str) -> DataFrame:
    """`dropDuplicates` by a column that rarely repeats, over stored rows: only hashes of it are
    shuffled, and the rows whose hash repeats, told by a broadcast bitmap of bounded size."""
    spot = F.pmod(F.xxhash64(key), F.lit(MARKS))
    word, bit = F.floor(spot / 64), (spot % 64).cast("int")
    repeated = rows.select(F.xxhash64(key).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    marks = repeated.select(F.pmod("_hash", F.lit(MARKS)).alias("_spot"))
    marks = marks.select(F.floor(F.col("_spot") / 64).alias("_word"), (F.col("_spot") % 64).cast("int").alias("_bit"))
    words = marks.groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    told = rows.withColumns({"_word": word, "_at": bit}).join(F.broadcast(words), "_word", "left")
    told = told.withColumn("_maybe", F.coalesce(F.getbit("_bits", F.col("_at")) == 1, F.lit(False)))
    alone = told.where(~F.col("_maybe")).select(*rows.columns)
    return alone.unionByName(told.where("_maybe").select(*rows.columns).dropDuplicates([key]))


def append_predictions(scored: DataFrame, path: str, batch: str) -> bool:
    """Log scored rows under their model run and the name of their batch.

    A run scores a batch into one directory of the log, which a repeated job replaces
    whole, also after one that failed half way: the rows are the same as after a single
    run, and the log is never read. Equal prediction ids within a batch are equal rows
    and are kept once.

    The scores are computed and stored first, and a failure there is the caller's. Only
    a log that cannot be written is survived: the caller learns that nothing was logged.
    """
    spark = scored.sparkSession
    place = f"{scratch_dir(spark)}/scored"
    scored.write.option("compression", "zstd").parquet(place)
    # Letters before the digits, so that no reader takes the name for a number.
    named = F.concat(F.lit("b-"), F.sha2(F.concat_ws("|", "model_run_id", F.lit(batch)), 256).substr(1, 32))
    stored = _once(spark.read.schema(scored.schema).parquet(place), "prediction_id").withColumn(PART, named)
    try:
        with shuffles_dropped(spark):
            _replace_parts(stored, path, PART)
    except Exception as error:  # noqa: BLE001 - whatever the sink raises
        print(f"prediction log not written: {error}")
        return False
    finally:
        remove(spark, place)
    return True


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)
