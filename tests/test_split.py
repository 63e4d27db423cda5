from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortloom.functions import order_hash
from cohortloom.operators import split

KEY, LABEL = "feature_signature", "label"
LABELS = ("x", "y", "z")


@pytest.fixture(scope="module")
def cohort(spark):
    """One label with 15 groups, one with a single group, one with 900 groups of
    which one holds a third of all rows."""
    groups = spark.range(916).select(
        F.sha2(F.col("id").cast("string"), 256).alias(KEY),
        F.when(F.col("id") < 15, "x").when(F.col("id") == 15, "y").otherwise("z").alias(LABEL),
        F.when(F.col("id") == 20, 1000).otherwise(2).alias("copies"),
    )
    rows = groups.select(KEY, LABEL, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return rows.withColumn("row_id", F.concat_ws("-", KEY, "copy")).drop("copy")


def plain(rows):
    """The rule said directly, on a few rows, in Python."""
    sides = {}
    for label in LABELS:
        keys = sorted(
            {row[KEY] for row in rows if row[LABEL] == label}, key=lambda k: hashlib.sha256(f"{k}42".encode()).hexdigest()
        )
        train = max(1, min(len(keys) - 1, int(len(keys) * 0.7 + 0.5)))
        sides.update({key: "train" if at < train else "test" for at, key in enumerate(keys)})
    return sides


def test_split_follows_the_rule(cohort):
    expected = plain(cohort.select(KEY, LABEL).distinct().collect())
    result = split.group_split(cohort, KEY, LABEL, LABELS)
    assert result.count() == cohort.count()
    assert {row[KEY]: row.split for row in result.select(KEY, "split").distinct().collect()} == expected
    assert {row[KEY]: row.split for row in split.assignment(cohort, KEY, LABEL).collect()} == expected
    groups = {(row.split, row.label): row.n_groups for row in split.split_report(result, KEY, LABEL).collect()}
    assert groups[("train", "x")] == 11  # 0.7 * 15 = 10.5, rounded half up
    assert groups[("train", "y")] == 1 and ("test", "y") not in groups


def test_two_pass_rank_equals_window_rank(cohort):
    ranked = split.group_rank(cohort, KEY, LABEL)
    order = Window.partitionBy(LABEL).orderBy(order_hash(F.col(KEY), 42))
    direct = cohort.select(KEY, LABEL).distinct().withColumn("rn", F.row_number().over(order))
    assert ranked.count() == 916
    assert ranked.select(KEY, LABEL, "rn").exceptAll(direct).count() == 0


def test_split_ignores_order_and_partitioning(cohort):
    first = split.group_split(cohort, KEY, LABEL, LABELS, on_conflict="trust")
    second = split.group_split(cohort.repartition(7).orderBy(F.rand(1)), KEY, LABEL, LABELS, on_conflict="trust")
    assert first.select("row_id", "split").exceptAll(second.select("row_id", "split")).count() == 0


@pytest.mark.parametrize("seed", [1, 7, 42])
def test_no_group_on_both_sides(cohort, seed):
    result = split.group_split(cohort, KEY, LABEL, LABELS, seed=seed, on_conflict="trust")
    train, test = result.where("split = 'train'"), result.where("split = 'test'")
    assert split.overlap(train, test, KEY).first().overlap == 0
    assert split.overlap(cohort, cohort, KEY).first().overlap == 916


def test_rows_are_not_shuffled_by_the_split(cohort):
    """The rows themselves only meet a broadcast: no exchange above their scan."""
    result = split.group_split(cohort, KEY, LABEL, LABELS, on_conflict="trust")
    plan = result._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_salted_attach_equals_plain(cohort):
    assignment = split.assignment(cohort, KEY, LABEL)
    plain_join = split.attach(cohort, assignment, KEY)
    salted = split.attach(cohort, assignment, KEY, hot=[])
    assert salted.count() == cohort.count()
    assert plain_join.exceptAll(salted.select(*plain_join.columns)).count() == 0
    kept = split.keep_groups(cohort, assignment.where("split = 'test'"), KEY)
    assert kept.count() == plain_join.where("split = 'test'").count()


def test_conflicts(spark):
    rows = spark.createDataFrame(
        [("k1", "x"), ("k1", "y"), ("k2", "x"), ("k3", "x"), (None, "x"), ("k4", "other"), ("k5", None), ("k6", "y")],
        f"{KEY} string, {LABEL} string",
    )
    reasons = {row[KEY]: row.reason for row in split.unsplittable(rows, KEY, LABEL, LABELS).collect()}
    assert reasons == {"k1": "several labels", None: "no signature", "k4": "undeclared label", "k5": "undeclared label"}
    with pytest.raises(split.ConflictError):
        split.group_split(rows, KEY, LABEL, LABELS)
    good, bad = split.without_conflicts(rows, KEY, LABEL, LABELS)
    assert good.count() == 3 and bad.count() == 5
    result = split.group_split(rows, KEY, LABEL, LABELS, on_conflict="quarantine")
    assert result.count() == 3 and result.where("split is null").count() == 0
    with pytest.raises(ValueError):
        split.group_split(rows, KEY, LABEL, LABELS, on_conflict="ignore")


def test_row_split_leaks_and_group_split_does_not(cohort):
    rows = {row.method: row for row in split.leakage_contrast(cohort, "row_id", KEY, LABEL, LABELS).collect()}
    assert rows["row"].shared_groups > 0
    assert rows["group"].shared_groups == 0 and rows["group"].test_groups > 0


def test_a_key_has_one_side_or_none(spark):
    rows = spark.createDataFrame(
        [("k1", "x"), ("k1", "y"), ("k2", "x"), ("k3", "x"), (None, "x"), ("k6", "y")], f"{KEY} string, {LABEL} string"
    )
    sides = split.assignment(rows, KEY, LABEL)
    assert {row[KEY] for row in sides.collect()} == {"k2", "k3", "k6"}
    assert split.attach(rows, sides, KEY).count() == rows.count()
    trusted = split.group_split(rows, KEY, LABEL, LABELS, on_conflict="trust")
    assert trusted.where(f"{KEY} is null and split is not null").count() == 0
