"""Leakage-safe splitting: whole signature groups go to one side.

The order of the groups inside a label is the order of a seeded SHA-256 of the
signature, so the split is the same whatever the partitioning. Nothing here
sorts or gathers the groups of a label in one task, although a label holds a
large part of the table: groups are counted per hash prefix, and only the one
prefix that contains the cut is looked at closely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions import order_hash

PREFIX = 4
"""Hex digits of the order hash that form a prefix: 65 536 prefixes a label."""


class ConflictError(ValueError):
    """A signature carries several labels, an undeclared one, or is missing."""


def groups(df: DataFrame, key: str, label: str) -> DataFrame:
    """Distinct (key, label) pairs."""
    return df.select(key, label).distinct()


def heavy_keys(df: DataFrame, key: str, share: float | None = None) -> list:
    """Keys that alone hold more than `share` of the rows: by default, of an average task.

    One pass over the key column fills a sketch of frequent items. It tracks eight keys
    for each that the share leaves room for, so its size does not grow with the table and
    its counts are off by less than half the share: it may name a key that is a little
    less frequent, and misses none. At most 1 / share keys come to the driver.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = share or 1 / parts
    most = int(1 / share) + 1
    tracked = max(1024, 8 * most)
    sketch = F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("frequent")
    found = df.where(F.col(key).isNotNull()).agg(sketch, F.count(F.lit(1)).alias("n")).first()
    return [item["item"] for item in found["frequent"] or [] if item["count"] > share * found["n"]]


def attach(df: DataFrame, assignment: DataFrame, key: str, hot: Sequence | None = None) -> DataFrame:
    """Left join a per-group assignment (one row per key) to every row.

    Keys that hold a large part of the rows (`hot`, found by `heavy_keys` unless given)
    are joined apart: their assignments, one row a key and few, are broadcast, and their
    rows stay where they are. All other rows are joined by key, without an exchange
    where both tables are bucketed by it. Rows without a key meet nothing. `df` is
    read once for the sketch, its key column alone, and once for each kind of rows.

    Sides of a split need no join at all: see `with_side`.
    """
    hot = heavy_keys(df, key) if hot is None else list(hot)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    apart = F.col(key).isNull() | is_hot
    few = F.broadcast(assignment.where(is_hot))  # at most a row for each hot key
    return df.where(~apart).join(assignment, key, "left").unionByName(df.where(apart).join(few, key, "left"))


def keep_groups(df: DataFrame, wanted: DataFrame, key: str, hot: Sequence | None = None) -> DataFrame:
    """Rows whose key is among the wanted ones; hot keys are joined apart as by `attach`."""
    hot = heavy_keys(df, key) if hot is None else list(hot)
    rest, keys = df.where(F.col(key).isNotNull()), wanted.select(key)
    if not hot:
        return rest.join(keys, key, "left_semi")
    is_hot = F.col(key).isin(hot)
    few = F.broadcast(keys.where(is_hot).distinct())  # at most a row for each hot key
    return rest.where(~is_hot).join(keys, key, "left_semi").unionByName(rest.where(is_hot).join(few, key, "left_semi"))


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: number of keys found on both sides. Nothing is collected."""
    sides = left.select(key, F.lit(1).alias("side")).unionByName(right.select(key, F.lit(2).alias("side")))
    return (
        sides.groupBy(key)
        .agg(F.bit_or("side").alias("sides"))
        .agg(F.count_if(F.col("sides") == 3).alias("overlap"))
    )


def _ordered(pairs: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """Groups with their order hash and its prefix; a missing key has no place.

    Both users of this frame join on label and prefix or count by them. Saying
    here what the join would infer keeps the two plans equal, so the distinct
    groups are shuffled once and reused.
    """
    hashed = pairs.withColumn("order_hash", order_hash(F.col(key), seed))
    prefixed = hashed.withColumn("prefix", F.substring("order_hash", 1, PREFIX))
    return prefixed.where(F.col("prefix").isNotNull() & F.col(label).isNotNull())


def _prefix_counts(ordered: DataFrame, label: str) -> DataFrame:
    """(label, prefix, n, before, group_count); at most 65 536 rows a label."""
    by_label = Window.partitionBy(label)
    return (
        ordered.groupBy(label, "prefix")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(by_label.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("before", F.coalesce("before", F.lit(0)))
        .withColumn("group_count", F.sum("n").over(by_label))
    )


def train_count(group_count: Column, ratio: float) -> Column:
    """Groups of a label that go to train: rounded half up, within 1..count-1.

    A label with a single group keeps it in train.
    """
    return F.greatest(F.lit(1), F.least(group_count - 1, F.round(group_count * ratio))).cast("bigint")


def group_rank(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """(key, label, rn, group_count): exact position of each group in its label.

    Counting per prefix gives every prefix its offset; the row number is then
    only needed inside a prefix, which holds 1/65 536 of the groups of a label.
    """
    ordered = _ordered(groups(df, key, label), key, label, seed)
    offsets = _prefix_counts(ordered, label).select(label, "prefix", "before", "group_count")
    inside = Window.partitionBy(label, "prefix").orderBy("order_hash")
    return (
        ordered.withColumn("inside", F.row_number().over(inside))
        .join(offsets, [label, "prefix"])
        .select(key, label, (F.col("before") + F.col("inside")).cast("bigint").alias("rn"), "group_count")
    )


def cut_points(
    df: DataFrame, key: str, label: str, labels: Sequence, seed: int = 42, ratio: float = 0.70
) -> DataFrame:
    """(label, cut): order hash of the last train group. One row per label.

    Only the declared labels are looked at, so the number of rows is bounded by
    the schema, not by the data.
    """
    pairs = groups(df.where(F.col(label).isin(*labels)), key, label)
    ordered = _ordered(pairs, key, label, seed)
    cut_prefix = (
        _prefix_counts(ordered, label)
        .withColumn("train_n", train_count(F.col("group_count"), ratio))
        .where((F.col("before") < F.col("train_n")) & (F.col("train_n") <= F.col("before") + F.col("n")))
        .select(label, "prefix", (F.col("train_n") - F.col("before")).alias("wanted"))
    )
    return (
        ordered.join(F.broadcast(cut_prefix), [label, "prefix"])
        .withColumn("rn", F.row_number().over(Window.partitionBy(label).orderBy("order_hash")))
        .where(F.col("rn") == F.col("wanted"))
        .select(label, F.col("order_hash").alias("cut"))
    )


def unsplittable(df: DataFrame, key: str, label: str, labels: Sequence) -> DataFrame:
    """(key, reason) of groups that cannot be put on one side by their label."""
    return (
        df.select(key, F.col(label).isin(*labels).alias("declared"), F.xxhash64(label).alias("hashed"))
        .groupBy(key)
        .agg(
            F.count_if(~F.coalesce("declared", F.lit(False))).alias("undeclared"),
            (F.min("hashed") != F.max("hashed")).alias("conflicting"),
        )
        .select(
            key,
            F.when(F.col(key).isNull(), "no signature")
            .when(F.col("conflicting"), "several labels")
            .when(F.col("undeclared") > 0, "undeclared label")
            .alias("reason"),
        )
        .where(F.col("reason").isNotNull())
    )


def without_conflicts(
    df: DataFrame, key: str, label: str, labels: Sequence
) -> tuple[DataFrame, DataFrame]:
    """(rows that can be split, quarantined rows with the reason). Together all rows."""
    # Rows without a key need no partner, and would all meet in one.
    bad = unsplittable(df, key, label, labels).where(F.col(key).isNotNull())
    marked = attach(df.where(F.col(key).isNotNull()), bad, key)
    unsigned = df.where(F.col(key).isNull()).withColumn("reason", F.lit("no signature"))
    quarantined = marked.where(F.col("reason").isNotNull()).unionByName(unsigned)
    return marked.where(F.col("reason").isNull()).drop("reason"), quarantined


def group_split(
    df: DataFrame,
    key: str,
    label: str,
    labels: Sequence,
    seed: int = 42,
    ratio: float = 0.70,
    on_conflict: str = "raise",
) -> DataFrame:
    """Add `split` (train or test) so that no group is on both sides.

    Once the cut of each label is known, a row needs nothing but its own hash:
    the rows are not shuffled at all, and a hot group costs nothing extra.

    `on_conflict="raise"` runs one job and fails if a group has several labels,
    an undeclared one or no key; `"quarantine"` leaves such groups out (take
    them from `without_conflicts`); `"trust"` skips the check for a caller who has
    made it, and rows without a key or of an undeclared label get a null split.
    """
    if on_conflict == "raise":
        bad = unsplittable(df, key, label, labels).take(5)
        if bad:
            raise ConflictError("; ".join(f"{row[key]}: {row.reason}" for row in bad))
    elif on_conflict == "quarantine":
        df, _ = without_conflicts(df, key, label, labels)
    elif on_conflict != "trust":
        raise ValueError(f"unknown conflict rule: {on_conflict}")
    return with_side(df, cut_points(df, key, label, labels, seed, ratio), key, label, seed)


def with_side(df: DataFrame, cuts: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """Add `split` from the cut of each label; null without a key or for an undeclared label.

    A row's own hash decides, so rows are not shuffled, however they are spread over groups.
    """
    known = F.col("cut").isNotNull() & F.col(key).isNotNull()
    # One row per declared label.
    return (
        df.join(F.broadcast(cuts), label, "left")
        .withColumn("split", F.when(order_hash(F.col(key), seed) <= F.col("cut"), "train").when(known, "test"))
        .select(*df.columns, "split")
    )


def assignment(
    df: DataFrame, key: str, label: str, seed: int = 42, ratio: float = 0.70
) -> DataFrame:
    """(key, split) per group, from the exact ranks: one row a key.

    Keys with several labels and rows without a key have no side.
    """
    pairs = groups(df.where(F.col(key).isNotNull()), key, label)
    single = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.first(label).alias(label)).where("n = 1").drop("n")
    ranked = group_rank(single, key, label, seed)
    side = F.when(F.col("rn") <= train_count(F.col("group_count"), ratio), "train").otherwise("test")
    return ranked.select(key, side.alias("split"))


def split_report(split: DataFrame, key: str, label: str) -> DataFrame:
    """(split, label, n_rows, n_groups) in one pass."""
    return split.groupBy("split", label).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_groups")
    )


def row_split(df: DataFrame, id_column: str, seed: int = 42, ratio: float = 0.70) -> DataFrame:
    """Split by row, ignoring groups: the contrast, not a way to train."""
    cut = f"{int(ratio * 16**8):08x}"
    hashed = F.sha2(F.concat(F.col(id_column).cast("string"), F.lit(str(seed))), 256)
    return df.withColumn("split", F.when(F.substring(hashed, 1, 8) < cut, "train").otherwise("test"))


def shared_groups(split: DataFrame, key: str, side: str = "split") -> DataFrame:
    """One row: test groups, those of them also in train, and their share."""
    return _shared(split, key, [side]).select("test_groups", "shared_groups", "shared_ratio")


def _shared(split: DataFrame, key: str, sides: Sequence[str]) -> DataFrame:
    """(method, test_groups, shared_groups, shared_ratio) of every side column, from one grouping."""
    bit = {name: F.when(F.col(name) == "train", 1).when(F.col(name) == "test", 2) for name in sides}
    found = split.groupBy(key).agg(*[F.bit_or(value).alias(name) for name, value in bit.items()])
    counted = found.agg(
        *[F.count_if(F.col(name) >= 2).alias(f"{name}_test") for name in sides],
        *[F.count_if(F.col(name) == 3).alias(f"{name}_shared") for name in sides],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("method"),
                F.col(f"{name}_test").alias("test_groups"),
                F.col(f"{name}_shared").alias("shared_groups"),
            )
            for name in sides
        ]
    )
    share = F.when(F.col("test_groups") > 0, F.round(F.col("shared_groups") / F.col("test_groups"), 4)).otherwise(0.0)
    return counted.select(F.inline(rows)).withColumn("shared_ratio", share)


def leakage_contrast(
    df: DataFrame, id_column: str, key: str, label: str, labels: Sequence, seed: int = 42, ratio: float = 0.70
) -> DataFrame:
    """(method, test_groups, shared_groups, shared_ratio) of both ways to split, from one pass over the rows."""
    by_row = row_split(df, id_column, seed, ratio).withColumnRenamed("split", "row")
    both = with_side(by_row, cut_points(df, key, label, labels, seed, ratio), key, label, seed)
    return _shared(both.withColumnRenamed("split", "group"), key, ["row", "group"])
