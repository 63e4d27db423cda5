"""What the operators share: stored intermediate frames, text columns, salted joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.sources.files import remove, scratch_dir

MARKS = 1 << 24  # bits that tell most of the rows that are wanted from the others, whatever their number


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared folder and read it back.

    Cuts lineage: executors lost later are served from the files.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_path = path
    return back


def discard(*frames: DataFrame) -> None:
    """Delete stored frames whose successors are stored: nothing is computed from them any more."""
    for frame in frames:
        remove(frame.sparkSession, frame.stored_path)


def text_of(column: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def map_text(
    df: DataFrame, function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str | T.StructType
) -> DataFrame:
    """`mapInPandas` over whole input partitions."""
    return df.mapInPandas(function, schema=schema)


def chunks(frames: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into pieces of at most `rows` rows, so that what a step derives stays small."""
    for frame in frames:
        for at in range(0, len(frame), rows):
            yield frame.iloc[at : at + rows]


def salted_left_join(big: DataFrame, small: DataFrame, keys: Sequence[str], salts: int = 16) -> DataFrame:
    """Left join in which the rows of one key are dealt over `salts` tasks.

    `small` holds one row a key and is repeated for every salt; a null key finds nothing.
    """
    salt = "_salt"
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns if c not in keys]), F.lit(salts)).cast("int")
    left = big.withColumn(salt, spread)
    right = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, salt], "left").drop(salt)


def flagged(rows: DataFrame, wanted: DataFrame, flag: str) -> DataFrame:
    """`flag` is true where `key` is `wanted` and for a few more rows, told by a broadcast bitmap of bounded size."""

    def at(column: str) -> tuple[Column, Column]:
        bit = F.pmod(F.col(column), F.lit(MARKS))
        return F.floor(bit / 64), (bit % 64).cast("int")

    word, bit = at("wanted")
    marks = wanted.select(word.alias("_word"), bit.alias("_bit"))
    words = marks.groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    word, bit = at("key")
    found = rows.withColumn("_word", word).join(F.broadcast(words), "_word", "left")
    return found.select(*rows.columns, F.coalesce(F.getbit("_bits", bit) == 1, F.lit(False)).alias(flag))


def marked(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose `key` is `wanted`, and a few more; no row is shuffled."""
    return flagged(rows, wanted, "_marked").filter("_marked").drop("_marked")
