from __future__ import annotations

import time
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators import cleaning, search
from cohortloom.sources import files, keyed, store

OLD, NOW = datetime(2024, 1, 1), datetime(2024, 2, 1)
FIELDS = "id string, x int, note string, at int"


def target(spark):
    rows = spark.createDataFrame([("a", 1, "old", 0), ("b", 2, "old", 0), ("d", 4, None, 0)], FIELDS)
    return rows.withColumn("created_at", cleaning.timestamp(OLD))


def batch(spark):
    return spark.createDataFrame(
        [("b", 2, "old", 0), ("c", 3, "first", 1), ("c", 5, "last", 2), ("d", None, "new", 1)], FIELDS
    )


def test_merge(spark):
    merged = {row.id: row for row in store.merge_by_key(target(spark), batch(spark), "id", NOW, "at").collect()}
    assert sorted(merged) == ["a", "b", "c", "d"]
    assert (merged["c"].x, merged["c"].note, merged["c"].created_at) == (5, "last", NOW)
    assert (merged["d"].x, merged["d"].note, merged["d"].created_at) == (None, "new", OLD)
    assert merged["a"].x == 1 and merged["a"].created_at == OLD
    counts = store.merge_counts(target(spark), batch(spark), "id", "at").first()
    assert tuple(counts) == (3, 1, 2, 1)


def test_merge_twice_changes_nothing(spark):
    once = store.merge_by_key(target(spark), batch(spark), "id", NOW, "at")
    twice = store.merge_by_key(once, batch(spark), "id", datetime(2025, 1, 1), "at")
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    assert store.merge_counts(once, batch(spark), "id", "at").first().modified == 0


def with_null_keys(spark):
    old = spark.createDataFrame([(None, 9, "nobody", 0), ("a", 1, "old", 0)], FIELDS).withColumn("created_at", cleaning.timestamp(OLD))
    return old, spark.createDataFrame([(None, 7, "n", 1), (None, 8, "m", 2), ("z", 1, None, 1)], FIELDS)


def test_null_keys_are_merged_as_a_key(spark):
    old, new = with_null_keys(spark)
    merged = {tuple(row) for row in store.merge_by_key(old, new, "id", NOW, "at").collect()}
    assert merged == {(None, 8, "m", 2, OLD), ("a", 1, "old", 0, OLD), ("z", 1, None, 1, NOW)}
    assert tuple(store.merge_counts(old, new, "id", "at").first()) == (2, 1, 1, 1)
    fresh = {tuple(row) for row in store.merge_by_key(old.where("id = 'a'"), new, "id", NOW, "at").collect()}
    assert (None, 8, "m", 2, NOW) in fresh and len(fresh) == 3


def files_of(root):
    return {path: path.read_bytes() for path in root.rglob("*.parquet")}


def test_a_batch_rewrites_its_buckets_alone(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i}", i, "first", 0) for i in range(200)], FIELDS)
    schema = rows.withColumn("created_at", cleaning.timestamp(OLD)).schema
    table = keyed.KeyedTable(str(tmp_path / "t"), "id", schema, buckets=16)
    assert table.read(spark).count() == 0
    assert table.merge(rows, OLD) == {"total": 200, "inserted": 200, "matched": 0, "modified": 0}
    before = files_of(tmp_path / "t")
    batch_rows = spark.createDataFrame([("k7", 70, "later", 1), ("k7", 71, "last", 2), (None, 1, "nobody", 0)], FIELDS)
    assert table.merge(batch_rows, NOW, "at") == {"total": 2, "inserted": 1, "matched": 1, "modified": 1}
    after = files_of(tmp_path / "t")
    kept = {path for path in before if after.get(path) == before[path]}
    changed = {path.parent.name for path in before.keys() | after.keys() if path not in kept}
    assert len(changed) <= 2 and len({path.parent.name for path in kept}) >= 12
    merged = {row.id: row for row in table.read(spark).collect()}
    assert len(merged) == 201 and (merged["k7"].x, merged["k7"].created_at) == (71, OLD)
    assert (merged[None].note, merged[None].created_at) == ("nobody", NOW)
    # A repeated batch changes nothing, whatever the time.
    assert table.merge(batch_rows, datetime(2025, 1, 1), "at")["modified"] == 0
    assert {tuple(row) for row in table.read(spark).collect()} == {tuple(row) for row in merged.values()}


def test_bucketed_merge_equals_the_plain_one(spark, tmp_path):
    old, new = with_null_keys(spark)
    table = keyed.KeyedTable(str(tmp_path / "t"), "id", old.schema, buckets=3)
    table.merge(old.drop("created_at"), OLD)
    counts = table.merge(new, NOW, "at")
    assert {tuple(r) for r in table.read(spark).collect()} == {tuple(r) for r in store.merge_by_key(old, new, "id", NOW, "at").collect()}
    assert counts == store.merge_counts(old, new, "id", "at").first().asDict()
    assert table.merge(new.limit(0), NOW, "at") == {"total": 0, "inserted": 0, "matched": 0, "modified": 0}
    assert table.read(spark).count() == 3


def test_keyed_table_reads_one_bucket_for_a_key(spark, tmp_path):
    old, _ = with_null_keys(spark)
    table = keyed.KeyedTable(str(tmp_path / "t"), "id", old.schema, buckets=8)
    table.merge(old.drop("created_at"), OLD)
    found = table.lookup(spark, "a")
    assert [row.x for row in found.collect()] == [1] and [row.x for row in table.lookup(spark, None).collect()] == [9]
    assert "PartitionFilters: [isnotnull(_bucket" in found._jdf.queryExecution().executedPlan().toString()


def test_null_keys_can_be_refused(spark, tmp_path):
    old, new = with_null_keys(spark)
    table = keyed.KeyedTable(str(tmp_path / "t"), "id", old.schema, buckets=3, null_keys="refuse")
    with pytest.raises(keyed.KeyedTableError, match="2 rows of the batch have no id"):
        table.merge(new, NOW, "at")
    assert table.read(spark).count() == 0
    with pytest.raises(keyed.KeyedTableError, match="lacks columns"):
        table.merge(new.drop("note"), NOW, "at")


def test_repeated_key_without_order_fails(spark):
    with pytest.raises(Exception, match="key repeats in the batch: c"):
        store.merge_by_key(target(spark), batch(spark), "id", NOW).collect()
    single = batch(spark).where("id <> 'c'")
    assert store.merge_by_key(target(spark), single, "id", NOW).count() == 3


def test_named_result_is_replaced(spark):
    results = spark.createDataFrame(
        [("risk", 1, OLD), ("risk", 5, NOW), (None, 7, OLD)], "name string, total int, created_at timestamp_ntz"
    )
    document = spark.createDataFrame([(2,), (3,)], "total int")
    kept = store.put_result(results, "risk", document, NOW)
    both = store.put_result(kept, "quality", document, NOW)
    assert {tuple(row) for row in both.collect()} == {
        ("risk", 2, OLD), ("risk", 3, OLD), ("quality", 2, NOW), ("quality", 3, NOW), (None, 7, OLD)
    }


def test_version_registry(spark):
    registry = store.register_version(store.empty_registry(spark), "v1", target(spark), OLD)
    registry = store.register_version(registry, "v2", batch(spark), OLD)
    registry = store.register_version(registry, "v1", batch(spark), NOW)
    assert {tuple(row) for row in registry.collect()} == {("v1", 4, NOW), ("v2", 4, OLD)}


def test_versions_stand_side_by_side(spark, tmp_path):
    store.write_version(target(spark), str(tmp_path), "v1")
    store.write_version(batch(spark), str(tmp_path), "v2")
    assert store.read_version(spark, str(tmp_path), "v1").count() == 3
    with pytest.raises(Exception, match="(?i)already exists"):
        store.write_version(batch(spark), str(tmp_path), "v2")


def test_snapshot(spark, tmp_path):
    counted = spark.createDataFrame([("level|Low", 2), ("age|<20", 1), ("cross|level_age|Low|<20", 1)], "key string, n bigint")
    store.append_snapshot(counted, f"{tmp_path}/s", OLD)
    store.append_snapshot(counted.withColumn("n", F.lit(9).cast("bigint")), f"{tmp_path}/s", NOW)
    store.append_snapshot(counted, f"{tmp_path}/s", OLD)  # taken again
    snapshots = store.read_snapshots(spark, f"{tmp_path}/s")
    assert snapshots.count() == 6
    assert [row.n for row in search.latest(snapshots, "created_at").collect()] == [9, 9, 9]
    sections = {row.section for row in search.latest(snapshots, "created_at").collect()}
    assert sections == {"level", "age", "cross"}


def test_latest_puts_rows_without_a_time_last(spark):
    frame = spark.createDataFrame([(1, None), (2, OLD), (3, NOW)], "id int, t timestamp_ntz")
    assert search.latest(frame, "t").first().id == 3
    assert search.latest(frame.where("t is null"), "t").first().id == 1
    assert search.latest(frame.limit(0), "t").count() == 0


def test_newest_snapshot_is_read_alone(spark, tmp_path):
    counted = spark.createDataFrame([("level|Low", 2), ("age|<20", 1)], "key string, n bigint")
    for month in (1, 3, 2):
        store.append_snapshot(counted.withColumn("n", F.lit(month).cast("bigint")), f"{tmp_path}/s", datetime(2024, month, 1))
    newest = store.latest_snapshot(spark, f"{tmp_path}/s")
    assert [(row.n, row.created_at) for row in newest.collect()] == [(3, datetime(2024, 3, 1))] * 2
    text = newest._jdf.queryExecution().executedPlan().toString()
    assert "taken" in text.split("PartitionFilters: ")[1].split("]")[0] and text.count("FileScan") == 1
    assert "Join" not in text and len(newest.inputFiles()) >= 2


def test_failing_log_keeps_the_scores(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    scored = target(spark).withColumnRenamed("id", "prediction_id").withColumn("model_run_id", F.lit("7"))
    assert store.append_predictions(scored, f"{tmp_path}/file/log", "1") is False
    assert scored.count() == 3
    for _ in range(2):
        assert store.append_predictions(scored, f"{tmp_path}/log", "1") is True
    assert spark.read.parquet(f"{tmp_path}/log").count() == 3
    with pytest.raises(Exception, match="no score"):
        store.append_predictions(scored.withColumn("bad", F.raise_error(F.lit("no score"))), f"{tmp_path}/log", "1")
    assert store.read_predictions(spark, f"{tmp_path}/log").count() == 3


def test_log_parts_are_replaced_and_never_read(spark, tmp_path):
    scored = target(spark).withColumnRenamed("id", "prediction_id").withColumn("model_run_id", F.lit("7"))
    log = tmp_path / "log"
    assert store.append_predictions(scored.union(scored), str(log), "1")  # equal ids are kept once
    first = files_of(log)
    assert store.append_predictions(scored.where("prediction_id = 'a'"), str(log), "2")
    assert store.append_predictions(scored.withColumn("model_run_id", F.lit("8")), str(log), "1")
    assert first.items() <= files_of(log).items()
    # What a job that failed half way left behind goes with its part.
    part = next(iter(first)).parent
    for path in part.glob("*.parquet"):
        path.unlink()
    (part / "part-9.parquet").write_bytes(b"not a table")
    assert store.append_predictions(scored, str(log), "1")
    assert store.read_predictions(spark, str(log)).groupBy("model_run_id").count().orderBy("model_run_id").collect() == [("7", 4), ("8", 3)]
    assert store.read_predictions(spark, str(log)).columns == scored.columns


POSITIONAL = {
    "a.csv": b"\xef\xbb\xbfid,a,level\r\n1,2,Low\r\n\r\n2,3\r\n3,4,High,9\r\n4,5,High\r\n",
    "b.csv": b"5,2,Low\nid,a,level\n6,3\n\n7,1,Low\n",
}


def test_positional_lines(spark, tmp_path):
    for name, content in POSITIONAL.items():
        (tmp_path / name).write_bytes(content)
    rows, bad = files.read_positional(spark, str(tmp_path), ["id", "a", "level"])
    assert sorted(row.id for row in rows.collect()) == ["1", "4", "5", "7"]
    assert rows.select("level").where("level = 'Low'").count() == 3
    assert rows.count() == 4  # a pruned read must not let short lines in
    assert bad.first().bad_rows == 3
    rows, bad = files.read_positional(spark, str(tmp_path), ["id", "a", "level"], labels=("Medium", "HIGH"))
    assert [row.id for row in rows.collect()] == ["4"] and bad.first().bad_rows == 6


def test_positional_lines_are_counted_while_they_are_stored(spark, tmp_path):
    for name, content in POSITIONAL.items():
        (tmp_path / name).write_bytes(content)
    columns = ["id", "a", "level"]
    for at, labels in enumerate(((), ("Medium", "HIGH"))):
        rows, bad = files.read_positional(spark, str(tmp_path), columns, labels)
        scans = []
        spark.sparkContext.setJobGroup(f"positional-{at}", "")
        stored, counted = files.load_positional(spark, str(tmp_path), columns, str(tmp_path / f"_stored{at}"), labels)
        scans = spark.sparkContext.statusTracker().getJobIdsForGroup(f"positional-{at}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(scans) == 1  # one job reads the text, writes the rows and counts
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, rows.collect()))
        assert counted == bad.first().bad_rows


def test_clean_csv_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "c.csv").write_bytes(b"\xef\xbb\xbfid,a\n1,2\n")
    schema = files.text_schema(["id", "a"])
    assert [tuple(row) for row in files.read_clean(spark, str(tmp_path), schema).collect()] == [("1", "2")]
    with pytest.raises(Exception, match="(?i)header"):
        files.read_clean(spark, str(tmp_path), files.text_schema(["id", "b"])).collect()


def test_counts_file(spark, tmp_path):
    path = tmp_path / "counts.tsv"
    path.write_text("\ufefflevel|Low\t1\nlevel|Low\t7\n\ncross|a|b|c\t2\nbad\tx\nno tab\nfraction\t1.5\nthree\tx\t5\n", encoding="utf-8")
    got = {tuple(row) for row in files.read_counts(spark, str(path)).collect()}
    assert got == {("level", "level|Low", 7), ("cross", "cross|a|b|c", 2)}


def test_export(spark, tmp_path):
    files.write_export(batch(spark), f"{tmp_path}/out")
    written = files.read_clean(spark, f"{tmp_path}/out", batch(spark).schema)
    assert written.exceptAll(batch(spark)).count() == 0 and written.count() == batch(spark).count()
    with pytest.raises(files.EmptyExportError):
        files.write_export(batch(spark).limit(0), f"{tmp_path}/none")


def test_scratch_uses_the_shared_folder():
    def session(folder):
        conf = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "file:/warehouse"}
        return SimpleNamespace(conf=SimpleNamespace(get=conf.get))

    first, second = (files.scratch_dir(session("hdfs://shared/work/")) for _ in range(2))
    assert first != second and first.startswith("hdfs://shared/work/cohortloom-")
    assert files.scratch_dir(session(None)).startswith("file:/warehouse/cohortloom-")


def scratch(spark, monkeypatch, tmp_path):
    """From now on scratch folders are made below `tmp_path`; what is left in them."""
    import uuid

    for module in (files, keyed, store):
        monkeypatch.setattr(module, "scratch_dir", lambda _: f"{tmp_path}/scratch/{uuid.uuid4().hex}")
    return lambda: sorted(str(path) for path in (tmp_path / "scratch").rglob("*.parquet"))


def kept(spark, before=1 << 30):
    """Files of shuffles; as they are deleted in the background, looked for until there are no more than before."""
    for _ in range(100):
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").count("shuffle_")
        if found <= before:
            break
        time.sleep(0.1)
    return found


def test_what_a_job_shuffles_goes_with_it(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(name), kept(spark)
    with files.shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
        spark.range(1000).repartition(5).write.parquet(f"{tmp_path}/rows")
    assert kept(spark, before) <= before and spark.conf.get(name) == was
    with pytest.raises(ZeroDivisionError), files.shuffles_dropped(spark):
        1 / 0
    assert spark.conf.get(name) == was


def test_merges_and_logs_leave_no_scratch(spark, tmp_path, monkeypatch):
    left = scratch(spark, monkeypatch, tmp_path)
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, note string")
    table = keyed.KeyedTable(f"{tmp_path}/table", "id", T.StructType([*rows.schema.fields, T.StructField("created_at", T.TimestampNTZType())]), 4)
    before = kept(spark)
    for _ in range(2):
        counts = table.merge(rows, datetime(2024, 1, 1))
    assert counts == {"total": 3, "inserted": 0, "matched": 3, "modified": 0}
    assert sorted(table.read(spark).select("note").collect()) == [("a",), ("b",), ("c",)]
    assert left() == [] and kept(spark, before) <= before
    scored = rows.select(F.col("note").alias("prediction_id"), F.lit("r").alias("model_run_id"))
    assert store.append_predictions(scored.union(scored), f"{tmp_path}/log", "1")
    assert store.read_predictions(spark, f"{tmp_path}/log").count() == 3 and left() == []


def test_repeated_ids_are_dropped_wherever_their_hashes_meet(spark, monkeypatch):
    """Also rows whose id repeats nowhere but meets a repeated one in the bitmap, null ids and columns that cannot be compared."""
    rows = spark.range(300).select((F.col("id") % 200).cast("string").alias("id"), F.create_map(F.lit("k"), F.col("id") % 200).alias("map"))
    rows = rows.unionByName(spark.createDataFrame([(None, None), (None, None)], "id string, map map<string, bigint>"))
    for marks in (64, 128, store.MARKS):
        monkeypatch.setattr(store, "MARKS", marks)
        got = store._once(rows, "id").collect()
        assert len(got) == 201 and {(r.id, r.map and r.map["k"]) for r in got} == {*((str(i), i) for i in range(200)), (None, None)}
