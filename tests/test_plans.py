"""Shapes the physical plans must keep."""

from __future__ import annotations

import re
from datetime import datetime

import pytest

from pyspark.sql import functions as F

from cohortloom.operators import cleaning, distribution, model, quality, risk, search, split
from cohortloom.plans import bindings as B
from cohortloom.plans.bindings import COHORT, RAW
from cohortloom.sources import files

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "rows")
    cleaning.enrich(B.cohort(spark, SF_DIR), COHORT, "v1", datetime(2024, 1, 1)).write.parquet(path)
    return spark.read.parquet(path)


def plan(frame, final=False):
    if final:
        frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def count(text, pattern):
    return len(re.findall(pattern, text))


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(search.where(stored, COHORT, label="high", feature="ind_qty", operator="gte", value=6).select("subject_id"))
    assert "EqualTo(level,High)" in text and "GreaterThanOrEqual(ind_qty,6)" in text
    assert "ReadSchema: struct<subject_id:string,ind_qty:int,level:string>" in text
    assert "EqualTo(subject_id,7-1)" in plan(search.lookup(stored, "subject_id", "7-1"))


def test_whole_number_columns_are_not_parsed(stored):
    text = plan(risk.risk_factors(stored, COHORT)) + plan(quality.violation_counts(stored, COHORT))
    assert "translate" not in text and "try_cast" not in text


@pytest.mark.parametrize(
    "build, exchanges",
    [
        (lambda df: distribution.distribution_table(df, COHORT), 2),
        (lambda df: distribution.value_counts(df, COHORT), 1),
        (lambda df: risk.risk_factors(df, COHORT), 3),
        (lambda df: risk.correlation_table(df, COHORT), 1),
        (lambda df: quality.violation_counts(df, COHORT), 1),
        (lambda df: quality.profile(df, COHORT), 2),
    ],
)
def test_one_scan_and_few_exchanges(stored, build, exchanges):
    text = plan(build(stored))
    assert count(text, "FileScan") == 1
    assert count(text, " Exchange ") == exchanges
    assert count(text, "partial_") >= 1


def test_audit_scans(stored):
    """Counters and digests read the features, the id count reads the id alone."""
    text = plan(quality.quality_summary(stored, COHORT))
    assert count(text, "FileScan") == 3 and "Expand" not in text
    assert "ReadSchema: struct<subject_id:string>" in text


def test_no_nested_loops(stored):
    for frame in (
        quality.quality_summary(stored, COHORT),
        distribution.share(stored, "level"),
        split.group_split(stored, "feature_signature", "level", COHORT.labels, on_conflict="trust"),
    ):
        assert "NestedLoop" not in plan(frame) and "Cartesian" not in plan(frame)


def test_distinct_groups_are_shuffled_once(stored):
    result = split.group_split(stored, "feature_signature", "level", COHORT.labels, on_conflict="trust")
    text = plan(result, final=True)
    assert "ReusedExchange" in text
    assert "SortMergeJoin" not in text


def test_a_side_of_the_manifest_is_read_alone(spark, stored, tmp_path):
    result = split.group_split(stored, "feature_signature", "level", COHORT.labels, on_conflict="trust")
    files.write_manifest(result, f"{tmp_path}/m")
    text = plan(files.read_manifest(spark, f"{tmp_path}/m", "train"))
    assert re.search(r"PartitionFilters: \[[^\]]*split#\d+ = train", text)


def test_page_is_a_top_k(stored):
    text = plan(search.page_rows(stored, search.sort_columns(COHORT, "age", "desc"), 2, 50))
    assert "TakeOrderedAndProject" in text and "Exchange range" not in text


def test_validation_parses_each_cell_once(spark):
    """The filter and the error list share one cast a feature; that holds for audits too."""
    rows = B.raw(spark, SF_DIR)
    valid, quarantine = cleaning.validate(rows, RAW)
    for frame in (valid, quarantine, quality.violation_counts(rows, RAW)):
        text = frame._jdf.queryExecution().optimizedPlan().toString()
        # RAW_SQL itself casts numbers to text; a parsed cell goes through translate.
        assert count(text, r"translate\(") == len(RAW.features)


def test_evaluation_reads_its_rows_once(spark, tmp_path):
    B.judged(spark, SF_DIR).write.parquet(f"{tmp_path}/j")
    text = plan(model.evaluate(spark.read.parquet(f"{tmp_path}/j"), "actual", "predicted", B.FLAGS))
    assert count(text, "FileScan") == 1 and "Join" not in text and count(text, " Exchange ") == 2


@pytest.fixture(scope="module")
def searchable(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("searchable") / "rows")
    rows = cleaning.enrich(B.cohort(spark, "/root/testdata/sf0.01"), COHORT, "v1", datetime(2024, 1, 1))
    files.write_searchable(rows, path, COHORT, files=4, group_bytes=64 << 10)
    return spark.read.parquet(path)


def rows_read(frame):
    """Rows that the scan hands on: whole row groups, as far as they were not skipped."""
    frame.collect()
    executed = frame._jdf.queryExecution().executedPlan()
    if executed.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        executed = executed.executedPlan()
    leaves = executed.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_filters_skip_row_groups(spark, searchable):
    from glob import glob

    import pyarrow.parquet as pq

    paths = [path.removeprefix("file://") for path in searchable.inputFiles()]
    groups = [pq.ParquetFile(path).metadata.row_group(i) for path in paths for i in range(pq.ParquetFile(path).metadata.num_row_groups)]
    assert len(groups) > 12 and len(glob(paths[0])) == 1
    place = {name: i for i, name in enumerate(pq.ParquetFile(paths[0]).schema.names)}

    def could_hold(group, label, low, high):
        level, age = (group.column(place[name]).statistics for name in ("level", "age"))
        return level.min <= label <= level.max and age.min <= high and age.max >= low

    found = search.where(searchable, COHORT, label="high", number_min=36, number_max=40)
    kept = [g.num_rows for g in groups if could_hold(g, "High", 36, 40)]
    assert "PushedFilters" in plan(found) and "EqualTo(level,High)" in plan(found)
    assert found.count() <= rows_read(found) <= sum(kept) < sum(g.num_rows for g in groups) / 2


def test_bloom_filters_skip_row_groups(spark, searchable):
    known = searchable.select("subject_id").first()[0]
    total = searchable.count()
    found = search.lookup(searchable, "subject_id", known)
    assert [row.subject_id for row in found.collect()] == [known]
    assert 0 < rows_read(found) < total / 3
    # Between the smallest and the largest id, so that bounds alone would skip nothing.
    assert rows_read(search.lookup(searchable, "subject_id", known + "x")) < total / 3


def test_hot_keys_are_found_and_joined_apart(spark, tmp_path):
    rows = B.skewed(spark, "/root/testdata/sf0.01")
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows").repartition(16)
    (hot,) = split.heavy_keys(rows, "feature_signature")
    assert rows.where(F.col("feature_signature") == hot).count() > rows.count() / 4
    assert split.heavy_keys(rows.where(F.col("feature_signature") != hot), "feature_signature") == []
    sizes = rows.where("feature_signature IS NOT NULL").groupBy("feature_signature").agg(F.count("*").alias("size"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = split.attach(rows, sizes, "feature_signature")
        tasks = sorted(row["n"] for row in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
        assert sum(tasks) == rows.count() and tasks[-1] <= 2 * tasks[len(tasks) // 2]
        wanted = split.keep_groups(rows, rows.where("row_id % 50 = 0"), "feature_signature")
        plain = rows.join(rows.where("row_id % 50 = 0").select("feature_signature"), "feature_signature", "left_semi")
        assert sorted(r.row_id for r in wanted.collect()) == sorted(r.row_id for r in plain.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_bucketed_sides_are_joined_without_an_exchange(spark, tmp_path):
    rows = B.skewed(spark, SF_DIR)
    hot = split.heavy_keys(rows, "feature_signature")
    sizes = rows.where("feature_signature IS NOT NULL").groupBy("feature_signature").agg(F.count("*").alias("size"))
    for name, frame in (("hot_rows", rows), ("hot_sizes", sizes)):
        writer = frame.write.bucketBy(8, "feature_signature").sortBy("feature_signature").option("path", f"{tmp_path}/{name}")
        writer.saveAsTable(name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = split.attach(spark.table("hot_rows"), spark.table("hot_sizes"), "feature_signature", hot)
        text = plan(joined)
        assert "SortMergeJoin" in text and "BroadcastHashJoin" in text
        assert count(text, " Exchange ") == 0
        assert joined.count() == rows.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("hot_rows", "hot_sizes"):
            spark.sql(f"DROP TABLE {name}")
