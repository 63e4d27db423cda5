"""One query per operator of the inventory: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom import functions as X
from cohortloom.operators import audit, cleaning, distribution, model, quality, risk, search, split
from cohortloom.plans import bindings as B
from cohortloom.plans.bindings import COHORT, RAW
from cohortloom.sources import files, ingest, keyed, store

NOW = datetime(2024, 2, 1, 12, 0, 0)
EARLIER = datetime(2024, 1, 15, 12, 0, 0)
VERSION = "v20240201"
GRADIENT = 1e-3  # of the mean log loss by a standardised coefficient, at the optimum
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RENAMES = {
    "o_orderkey": "order_key",
    "o_custkey": "customer_key",
    "o_orderstatus": "order_status",
    "o_totalprice": "total_price",
    "o_orderdate": "order_date",
    "o_orderpriority": "order_priority",
}
# One column too many and one too few against the damaged cohort.
EXPECTED_COLUMNS = ["subject_id", "age", "gender", "ind_part", "ind_qty", "ind_tax", "level"]


def query(function):
    QUERIES[function.__name__] = function
    return function


# Sources and sinks


@query
def read_clean_rows(spark, sf_dir):
    rows = B.cohort(spark, sf_dir)
    path = f"{files.scratch_dir(spark)}/clean"
    rows.write.option("header", True).csv(path)
    return files.read_clean(spark, path, rows.schema)


@query
def positional_bad_rows(spark, sf_dir):
    columns = [COHORT.id, *COHORT.features, COHORT.label]
    full = F.concat_ws(",", *columns)
    line = (
        F.when(F.col("age") == 13, F.concat_ws(",", *columns[:-1]))
        .when(F.col("age") == 17, F.concat(full, F.lit(",extra")))
        .when(F.col("age") == 19, F.concat(F.lit("\n"), full))
        .when(F.col("age") == 23, F.concat(F.lit(",".join(columns) + "\n"), full))
        .when(F.col("age") == 29, F.concat_ws(",", *columns[:-1], F.lit("Severe")))
        .otherwise(full)
    )
    path = f"{files.scratch_dir(spark)}/positional"
    B.cohort(spark, sf_dir).select(line.alias("value")).write.text(path)
    rows, bad = files.load_positional(spark, path, columns, f"{files.scratch_dir(spark)}/rows", COHORT.labels)
    good = distribution.counts(rows.select(F.lit("good").alias("kind")), ["kind"])
    return good.unionByName(spark.range(1).select(F.lit("bad").alias("kind"), F.lit(bad).cast("long").alias("n")))


@query
def split_manifest_roundtrip(spark, sf_dir):
    path = f"{files.scratch_dir(spark)}/manifest"
    files.write_manifest(group_split(spark, sf_dir), path)
    return files.read_manifest(spark, path)


@query
def counts_parse(spark, sf_dir):
    counted = distribution.distribution_table(B.cohort(spark, sf_dir), COHORT)
    path = f"{files.scratch_dir(spark)}/counts"
    counted.select(
        F.explode(
            F.array(
                F.concat_ws("\t", "key", "n"),
                F.concat(F.lit("junk|"), "key", F.lit("\tn/a")),
                F.concat_ws("\t", F.lit("three"), "key", "n"),
            )
        ).alias("value")
    ).write.text(path)
    return files.read_counts(spark, path)


@query
def clean_outputs_roundtrip(spark, sf_dir):
    rows = B.raw(spark, sf_dir)
    counting, ready = cleaning.published_frames(rows, RAW)
    report = quality.quality_report(cleaning.coerce_numeric(cleaning.clean_text(rows, RAW), RAW.features), RAW)
    places = files.write_outputs(counting, ready, report, files.scratch_dir(spark))
    return files.read_clean(spark, places["model_csv"], ready.schema)


@query
def export_rows(spark, sf_dir):
    rows = search.export_rows(B.cohort(spark, sf_dir), COHORT, label="high", feature="ind_qty", operator="gte", value=6)
    path = f"{files.scratch_dir(spark)}/export"
    files.write_export(rows, path)
    return files.read_clean(spark, path, rows.schema)


@query
def risk_export_wide(spark, sf_dir):
    return risk.risk_export(B.cohort(spark, sf_dir), COHORT)


def _store(spark, sf_dir):
    return B.bind(spark, sf_dir, B.STORE_SQL), B.bind(spark, sf_dir, B.BATCH_SQL)


@query
def upsert_merge(spark, sf_dir):
    target, batch = _store(spark, sf_dir)
    table = keyed.KeyedTable(files.scratch_dir(spark), "id", target.schema, buckets=16)
    table.merge(target.drop("created_at"), datetime(2024, 1, 1))
    table.merge(batch, NOW, order="updated_at")
    return table.read(spark)


@query
def upsert_counts(spark, sf_dir):
    target, batch = _store(spark, sf_dir)
    return store.merge_counts(target, batch, "id", order="updated_at")


@query
def ingest_chain(spark, sf_dir):
    """The stored table after two overlapping sheets."""
    rows = B.raw(spark, sf_dir)
    line = F.element_at(F.split(F.trim(RAW.id), "-"), 2).cast("int")
    place = files.scratch_dir(spark)
    kept = ingest.CohortStore(f"{place}/store", RAW, buckets=8)
    for sheet, lines, version, at in (("first", line <= 4, "v20240115", EARLIER), ("second", line >= 3, VERSION, NOW)):
        rows.where(lines).write.option("header", True).csv(f"{place}/{sheet}")
        kept.ingest(spark, f"{place}/{sheet}", version, at)
        files.remove(spark, f"{place}/{sheet}")
    return kept.read(spark)


@query
def distribution_snapshot(spark, sf_dir):
    path = f"{files.scratch_dir(spark)}/snapshots"
    store.append_snapshot(distribution.distribution_table(B.cohort(spark, sf_dir), COHORT), path, NOW)
    return store.read_snapshots(spark, path)


@query
def result_document(spark, sf_dir):
    """The stored risk result after it was replaced by a later one."""
    flat = [
        "rank", "indicator", "impact", "pct_high_when_high_value",
        *[F.col("mean_by_level")[label].alias(f"mean_{label.lower()}") for label in COHORT.labels],
    ]
    document = risk.factor_documents(B.cohort(spark, sf_dir), COHORT)
    dated = document.select(F.lit("risk").alias("name"), "*", F.lit(EARLIER).cast("timestamp_ntz").alias("created_at"))
    other = dated.withColumn("name", F.lit("other"))
    results = dated.where("rank <= 3").unionByName(other.where("rank = 1"))
    return store.put_result(results, "risk", document, NOW).select("name", *flat, "created_at")


@query
def version_registry(spark, sf_dir):
    registry = store.empty_registry(spark)
    registry = store.register_version(registry, "v20240101", B.table(spark, sf_dir, "orders"), datetime(2024, 1, 1))
    registry = store.register_version(registry, VERSION, B.table(spark, sf_dir, "orders"), datetime(2024, 1, 15))
    return store.register_version(registry, VERSION, B.cohort(spark, sf_dir), NOW)


# Projections and cleaning


@query
def schema_contract(spark, sf_dir):
    return cleaning.contract_report(B.raw(spark, sf_dir), EXPECTED_COLUMNS)


@query
def canonical_rename(spark, sf_dir):
    return cleaning.canonicalize(B.table(spark, sf_dir, "orders"), RENAMES)


@query
def clean_labels(spark, sf_dir):
    return cleaning.clean_text(B.raw(spark, sf_dir), RAW).select(RAW.id, RAW.label)


@query
def coerce_numeric(spark, sf_dir):
    return cleaning.coerce_numeric(B.raw(spark, sf_dir), RAW.features).select(RAW.id, *RAW.features)


@query
def to_int_truncate(spark, sf_dir):
    return cleaning.coerce_integer(B.raw(spark, sf_dir), RAW.features).select(RAW.id, *RAW.features)


def _banded(spark, sf_dir, mode):
    rows = X.with_numbers(B.raw(spark, sf_dir), ["age"], "number_")
    return rows.select(RAW.id, "age", X.age_band(F.col("number_age"), RAW, mode).alias("age_group"))


@query
def age_band_closed(spark, sf_dir):
    return _banded(spark, sf_dir, "closed_bins")


@query
def age_band_cut(spark, sf_dir):
    return _banded(spark, sf_dir, "right_closed")


@query
def encode_label(spark, sf_dir):
    rows = cleaning.clean_text(B.raw(spark, sf_dir), RAW)
    return rows.select(
        RAW.id,
        X.encode_label(F.col("level"), RAW).alias("level_encoded"),
        X.encode_label(F.col("level"), RAW, unknown=None).alias("level_encoded_or_null"),
    )


@query
def feature_signature(spark, sf_dir):
    return X.with_signature(B.raw(spark, sf_dir), RAW.features).select(RAW.id, "feature_signature")


@query
def bucket_ordinals(spark, sf_dir):
    rows = X.with_numbers(B.raw(spark, sf_dir), RAW.ordinals)
    return rows.select(RAW.id, *[X.bucket(F.col(name), RAW).alias(name) for name in RAW.ordinals])


@query
def enrich_rows(spark, sf_dir):
    return cleaning.enrich(B.raw(spark, sf_dir), RAW, VERSION, NOW)


@query
def published_frames(spark, sf_dir):
    counting, ready = cleaning.published_frames(B.raw(spark, sf_dir), RAW)
    return counting.select(F.lit("counting").alias("frame"), "*").unionByName(
        ready.select(F.lit("model").alias("frame"), "*"), allowMissingColumns=True
    )


@query
def decode_category(spark, sf_dir):
    rows = X.with_numbers(B.raw(spark, sf_dir), ["gender"])
    return rows.select(RAW.id, X.decode(F.col("gender"), RAW).alias("gender_name"))


# Filters, lookup, paging


_SEARCHABLE: dict[tuple[str, str], str] = {}


def _searchable(spark, sf_dir):
    """The stored cohort, written once a session and searched by every query."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SEARCHABLE or not files.exists(spark, _SEARCHABLE[key]):
        path = f"{files.scratch_dir(spark)}/searchable"
        files.write_searchable(cleaning.enrich(B.cohort(spark, sf_dir), COHORT, VERSION, NOW), path, COHORT)
        _SEARCHABLE[key] = path
    return spark.read.parquet(_SEARCHABLE[key])


def _found(spark, sf_dir, **filters):
    return search.where(_searchable(spark, sf_dir), COHORT, **filters).select(COHORT.id, *COHORT.features, COHORT.label)


@query
def search_eq(spark, sf_dir):
    return _found(spark, sf_dir, feature="ind_part", operator="eq", value=4)


@query
def search_gte(spark, sf_dir):
    return _found(spark, sf_dir, feature="ind_price", operator="gte", value=5)


@query
def search_lte(spark, sf_dir):
    return _found(spark, sf_dir, feature="ind_tax", operator="lte", value=3)


@query
def search_between(spark, sf_dir):
    return _found(spark, sf_dir, feature="ind_qty", operator="between", min_value=3, max_value=5)


@query
def search_between_reversed(spark, sf_dir):
    return _found(spark, sf_dir, feature="ind_qty", operator="between", min_value=5, max_value=3)


@query
def search_combined(spark, sf_dir):
    return _found(
        spark, sf_dir, label="high", category=1, number_min=36, number_max=48,
        feature="ind_price", operator="between", min_value=3, max_value=7,
    )


@query
def lookup_by_id(spark, sf_dir):
    return search.lookup(_searchable(spark, sf_dir), COHORT.id, "7-1")


@query
def validate_valid(spark, sf_dir):
    return cleaning.validate(B.raw(spark, sf_dir), RAW)[0]


@query
def validate_quarantine(spark, sf_dir):
    rows = cleaning.validate(B.raw(spark, sf_dir), RAW)[1]
    return rows.withColumn("errors", F.array_join("errors", ","))


@query
def prediction_history(spark, sf_dir):
    rows = search.history(B.prediction_log(spark, sf_dir), subject="42", predicted="purchase")
    return rows.orderBy(*search.newest_first())


@query
def search_sorted(spark, sf_dir):
    rows = search.where(B.cohort(spark, sf_dir), COHORT, label="Medium")
    return search.sort(rows, COHORT, "ind_price", "desc")


@query
def page_rows(spark, sf_dir):
    return search.page_rows(B.prediction_log(spark, sf_dir), search.newest_first(), page=3, size=50)


@query
def page_meta(spark, sf_dir):
    rows = search.history(B.prediction_log(spark, sf_dir), predicted="click")
    return search.page_meta(rows, page=0, size=500)


@query
def latest_snapshot(spark, sf_dir):
    """The newer of two stored snapshots, all its keys."""
    path = f"{files.scratch_dir(spark)}/snapshots"
    counted = distribution.distribution_table(B.cohort(spark, sf_dir), COHORT)
    store.append_snapshot(counted.where("key like 'level|%'"), path, EARLIER)
    store.append_snapshot(counted, path, NOW)
    return store.latest_snapshot(spark, path)


@query
def page_next(spark, sf_dir):
    """The page after row 100 of a sort with many ties."""
    rows = search.where(B.cohort(spark, sf_dir), COHORT, label="Medium")
    keys = search.sort_keys(COHORT, "ind_price", "desc")
    last = rows.orderBy(*search.ordered_by(keys)).offset(99).limit(1).first()
    return search.page_after(rows, keys, last and last.asDict(), 50)


# Joins and sets over groups


@query
def split_assign(spark, sf_dir):
    rows = B.grouped(spark, sf_dir)
    cuts = split.cut_points(rows, "feature_signature", "label", B.SEGMENTS)
    return split.with_side(rows, cuts, "feature_signature", "label")


@query
def attach_assignment(spark, sf_dir):
    """Every row with the number of labels its group has; one group holds a third of the rows."""
    rows = B.skewed(spark, sf_dir)
    pairs = split.groups(rows, "feature_signature", "label").where("feature_signature IS NOT NULL")
    return split.attach(rows, pairs.groupBy("feature_signature").agg(F.count(F.lit(1)).alias("n_labels")), "feature_signature")


@query
def keep_wanted_groups(spark, sf_dir):
    """Rows of the groups that some urgent order belongs to."""
    rows = B.skewed(spark, sf_dir)
    urgent = B.table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("row_id"))
    return split.keep_groups(rows, rows.join(urgent, "row_id", "left_semi"), "feature_signature")


@query
def rows_in_train_groups(spark, sf_dir):
    return split_assign(spark, sf_dir).where("split = 'train'").drop("split")


@query
def split_overlap(spark, sf_dir):
    shared = split.shared_groups(split_assign(spark, sf_dir), "feature_signature")
    return shared.select(F.col("shared_groups").alias("overlap"))


@query
def distinct_groups(spark, sf_dir):
    return split.groups(B.grouped(spark, sf_dir), "feature_signature", "label")


@query
def id_uniqueness(spark, sf_dir):
    return quality.uniqueness(B.cohort(spark, sf_dir), COHORT.id)


@query
def duplicate_full_rows(spark, sf_dir):
    return quality.duplicate_excess(B.cohort(spark, sf_dir), COHORT.checked)


# Distributions


def _dimension_counts(spark, sf_dir, *columns):
    return distribution.counts(distribution.dimensions(B.raw(spark, sf_dir), RAW), columns)


@query
def dist_level(spark, sf_dir):
    return _dimension_counts(spark, sf_dir, "level")


@query
def dist_gender(spark, sf_dir):
    return _dimension_counts(spark, sf_dir, "gender")


@query
def dist_age_group(spark, sf_dir):
    return _dimension_counts(spark, sf_dir, "age_group")


@query
def dist_level_age(spark, sf_dir):
    return _dimension_counts(spark, sf_dir, "level", "age_group")


@query
def dist_level_gender(spark, sf_dir):
    return _dimension_counts(spark, sf_dir, "level", "gender")


@query
def dist_indicator_values(spark, sf_dir):
    return distribution.value_counts(B.raw(spark, sf_dir), RAW)


@query
def distribution_long(spark, sf_dir):
    return distribution.distribution_table(B.raw(spark, sf_dir), RAW)


@query
def stats_level_filled(spark, sf_dir):
    return distribution.label_counts_filled(B.raw(spark, sf_dir), RAW)


@query
def stats_gender_filled(spark, sf_dir):
    return distribution.category_counts_filled(B.raw(spark, sf_dir), RAW)


@query
def stats_age_filled(spark, sf_dir):
    return distribution.band_counts_filled(B.raw(spark, sf_dir), RAW)


@query
def level_share(spark, sf_dir):
    return distribution.share(cleaning.clean_text(B.raw(spark, sf_dir), RAW), "level")


@query
def crosstab_age_level(spark, sf_dir):
    counting, _ = cleaning.published_frames(B.raw(spark, sf_dir), RAW)
    return distribution.crosstab(counting, "age_group", "level", RAW.labels)


@query
def crosstab_indicator_level(spark, sf_dir):
    counting, _ = cleaning.published_frames(B.raw(spark, sf_dir), RAW)
    return distribution.crosstab(counting, "ind_qty", "level", RAW.labels)


# Means and ranking


@query
def risk_means(spark, sf_dir):
    return risk.means_by_label(B.raw(spark, sf_dir), RAW, truncate=True)


@query
def risk_crosstab(spark, sf_dir):
    return risk.bucket_crosstab(B.raw(spark, sf_dir), RAW, truncate=True)


@query
def risk_n_by_level(spark, sf_dir):
    return risk.rows_by_label(B.raw(spark, sf_dir), RAW)


@query
def correlation_long(spark, sf_dir):
    return risk.correlation_table(B.raw(spark, sf_dir), RAW)


@query
def stats_avg_by_level(spark, sf_dir):
    return risk.means_by_label(B.raw(spark, sf_dir), RAW, missing="zero")


@query
def stats_avg_overall(spark, sf_dir):
    return risk.means_overall(B.raw(spark, sf_dir), RAW)


@query
def stats_chart_subset(spark, sf_dir):
    return risk.chart_means(B.raw(spark, sf_dir), RAW)


@query
def risk_impact(spark, sf_dir):
    return risk.impact(B.cohort(spark, sf_dir), COHORT)


@query
def risk_pct_high(spark, sf_dir):
    return risk.pct_in_bucket(B.raw(spark, sf_dir), RAW)


@query
def risk_rank(spark, sf_dir):
    return risk.rank_factors(B.cohort(spark, sf_dir), COHORT)


@query
def risk_top_k(spark, sf_dir):
    return risk.top_factors(B.cohort(spark, sf_dir), COHORT, 5)


@query
def risk_factors(spark, sf_dir):
    return risk.risk_factors(B.cohort(spark, sf_dir), COHORT)


# Quality


def _report(spark, sf_dir):
    rows = cleaning.coerce_numeric(cleaning.clean_text(B.raw(spark, sf_dir), RAW), RAW.features)
    return quality.quality_report(rows, RAW)


@query
def quality_summary(spark, sf_dir):
    return quality.quality_summary(B.raw(spark, sf_dir), RAW)


@query
def audit_in_batches(spark, sf_dir):
    """The audit of all rows from the states of three batches, one of them loaded twice."""
    rows = B.raw(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64(RAW.id), F.lit(3)))
    kept = audit.AuditStore(files.scratch_dir(spark), RAW)
    for part in (0, 1, 2, 1):
        limits = {name: None for name in ("invalid_age", "invalid_gender", "invalid_level", "invalid_risk_scale")}
        kept.add(str(part), rows.where(F.col("part") == part).drop("part"), limits=limits)
    return kept.summary(spark)


@query
def quality_report(spark, sf_dir):
    return _report(spark, sf_dir).select("check_name", "value")


@query
def quality_row_violations(spark, sf_dir):
    return quality.violation_counts(B.raw(spark, sf_dir), RAW)


@query
def quality_checks(spark, sf_dir):
    return quality.checks_table(quality.quality_summary(B.raw(spark, sf_dir), RAW), RAW)


@query
def quality_gate(spark, sf_dir):
    return quality.invalid_checks(_report(spark, sf_dir)).select("check_name", "value")


@query
def baseline_profile(spark, sf_dir):
    return quality.profile(B.raw(spark, sf_dir), RAW)


@query
def verify_table(spark, sf_dir):
    stored = cleaning.enrich(B.cohort(spark, sf_dir), COHORT, VERSION, NOW)
    lines = B.table(spark, sf_dir, "lineitem")
    quantity, status = F.col("l_quantity"), F.col("l_linestatus")
    wanted = {
        "total": F.count(F.lit(1)),
        "level:Low": F.count_if(quantity <= 16),
        "level:Medium": F.count_if((quantity > 16) & (quantity <= 33)),
        "level:High": F.count_if(quantity >= 33),
        "gender:1": F.count_if(status == "F"),
        "gender:2": F.count_if(status == "O"),
    }
    expected = lines.agg(*[value.alias(name) for name, value in wanted.items()]).select(
        F.inline(
            F.array(
                *[F.struct(F.lit(name).alias("check_name"), F.col(f"`{name}`").alias("expected")) for name in wanted]
            )
        )
    )
    snapshot = store.snapshot_rows(distribution.counts(stored, ["level"]).select(F.col("level").alias("key"), "n"), NOW)
    return quality.verify(stored, COHORT, expected, snapshot, raw_names=list(RENAMES))


@query
def label_conflicts(spark, sf_dir):
    return quality.label_conflicts(B.raw(spark, sf_dir), RAW)


# Leakage-safe split


@query
def split_group_rank(spark, sf_dir):
    return split.group_rank(B.grouped(spark, sf_dir), "feature_signature", "label")


@query
def group_split(spark, sf_dir):
    rows = B.grouped(spark, sf_dir)
    return split.group_split(rows, "feature_signature", "label", B.SEGMENTS).select(
        "row_id", "feature_signature", "label", "split"
    )


@query
def split_conflict_gate(spark, sf_dir):
    rows = B.grouped(spark, sf_dir, text="nation_text")
    return split.unsplittable(rows, "feature_signature", "label", B.SEGMENTS)


@query
def split_quarantine(spark, sf_dir):
    """Every row with its reason for quarantine: no signature, a signature under several labels, or none."""
    good, bad = split.without_conflicts(B.conflicting(spark, sf_dir), "feature_signature", "label", B.SEGMENTS)
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad).select("row_id", "label", "reason")


@query
def split_report(spark, sf_dir):
    return split.split_report(group_split(spark, sf_dir), "feature_signature", "label")


@query
def leakage_contrast(spark, sf_dir):
    return split.leakage_contrast(B.labelled(spark, sf_dir), "row_id", "feature_signature", "label", B.QUALITIES)


# Models


def _model_split(spark, sf_dir):
    """A stored manifest: fitting reads it many times, the split is computed once.

    Splitting reads its rows several times too, so the signed rows are stored before it,
    over all cores however few files the source has.
    """
    place = files.scratch_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with files.shuffles_dropped(spark):
        signed = X.with_signature(B.modelled(spark, sf_dir).repartition(parts), COHORT.features)
        signed.write.option("compression", "zstd").parquet(f"{place}/signed")
        signed = spark.read.parquet(f"{place}/signed")
        rows = split.group_split(signed, "feature_signature", COHORT.label, COHORT.labels)
        files.write_manifest(rows.select(COHORT.id, COHORT.label, *COHORT.features, "split"), f"{place}/manifest", dealt=True)
    files.remove(spark, f"{place}/signed")
    return files.read_manifest(spark, f"{place}/manifest")


def _logistic():
    return model.logistic(COHORT.label, COHORT.labels, COHORT.features)


def _forest():
    return model.forest(COHORT.label, COHORT.labels, COHORT.features)


def _fitted(spark, sf_dir, pipeline):
    parts = _model_split(spark, sf_dir)
    fitted = model.fit(pipeline, parts.where("split = 'train'"), COHORT.features)
    return fitted, parts.where("split = 'test'")


def _support(pred):
    """(actual, n, above_majority): test rows of each label, and whether all together are right more often than their majority."""
    right = F.coalesce(F.col(COHORT.label) == F.col("predicted_label"), F.lit(False))
    counted = pred.groupBy(F.col(COHORT.label).alias("actual")).agg(F.count(F.lit(1)).alias("n"), F.count_if(right).alias("hits"))
    labels = Window.partitionBy(F.lit(1))  # a row a label
    return counted.select("actual", "n", (F.sum("hits").over(labels) > F.max("n").over(labels)).alias("above_majority"))


@query
def fit_logistic(spark, sf_dir):
    """Support on the test rows, and by class whether the fit is at the optimum of its training rows."""
    parts = _model_split(spark, sf_dir)
    train, test = parts.where("split = 'train'"), parts.where("split = 'test'")
    fitted = model.fit(_logistic(), train, COHORT.features)
    moments = model.moments(fitted, train, COHORT.label, COHORT.features)
    by_class = moments.groupBy(F.col("label").alias("actual")).agg(
        F.max(F.when(F.col("term") == "(rows)", F.col("observed"))).alias("n_train"),
        F.max(F.when(F.col("term") == "age", F.col("observed"))).alias("train_age"),
        (F.max(F.abs("gradient")) <= GRADIENT).alias("optimal"),
    )
    return _support(model.predict(fitted, test)).join(by_class, "actual")


@query
def logistic_moments(spark, sf_dir):
    """What every class's rows hold of every feature, and whether the fit gives the class as much."""
    parts = _model_split(spark, sf_dir).where("split = 'train'")
    fitted = model.fit(_logistic(), parts, COHORT.features)
    met = F.abs(F.col("expected") - F.col("observed")) <= 0.005 * F.col("observed")
    return model.moments(fitted, parts, COHORT.label, COHORT.features).select("label", "term", "n", "observed", met.alias("met"))


@query
def fit_forest(spark, sf_dir):
    """Support on the test rows, and whether the trees as a table say the same of each, also after reloading."""
    fitted, test = _fitted(spark, sf_dir, _forest())
    place = files.scratch_dir(spark)
    model.save_model(fitted, f"{place}/model")
    loaded = model.load_model(f"{place}/model", COHORT.labels)
    scored = model.predict(fitted, test).drop("predicted_index", "probability")
    nodes = model.node_table(loaded, f"{place}/forest", spark)
    both = model.predict_by_joins(loaded, nodes, scored, f"{place}/rows")
    same = F.bool_and(F.col("joined_label").eqNullSafe(F.col("predicted_label")))
    agreed = both.groupBy(F.col(COHORT.label).alias("actual")).agg(same.alias("tables_agree"))
    return _support(spark.read.parquet(f"{place}/rows")).join(agreed, "actual")


@query
def eval_metrics(spark, sf_dir):
    return model.evaluate(B.judged(spark, sf_dir), "actual", "predicted", B.FLAGS)


@query
def confusion_matrix(spark, sf_dir):
    return model.confusion(B.judged(spark, sf_dir), "actual", "predicted", B.FLAGS)


@query
def per_class_f1(spark, sf_dir):
    classes = model.per_class(confusion_matrix(spark, sf_dir))
    return classes.select("label", "support", *[F.round(name, 4).alias(name) for name in ("precision", "recall", "f1")])


@query
def model_compare(spark, sf_dir):
    pipelines = {"logistic_regression": _logistic(), "random_forest": _forest()}
    compared = model.compare(pipelines, _model_split(spark, sf_dir), COHORT.label, COHORT.labels, COHORT.features)
    return compared.select("model", "n", "n_unscored", (F.col("accuracy") > 0.5).alias("above_half"))


@query
def score_batch(spark, sf_dir):
    fitted, _ = _fitted(spark, sf_dir, _logistic())
    scored = model.score(B.cohort(spark, sf_dir), fitted, COHORT.id, COHORT.labels, "logistic-1", VERSION, NOW)
    path = f"{files.scratch_dir(spark)}/predictions"
    for _ in range(2):  # a rerun adds nothing
        store.append_predictions(scored, path, "all rows")
    names = F.array(*[F.lit(name) for name in model.fitted_labels(fitted)])
    total = F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda a, b: a + b)
    return store.read_predictions(spark, path).select(
        "prediction_id",
        "subject_id",
        "model_run_id",
        "dataset_version",
        "created_at",
        (F.get(names, F.col("predicted_index")) == F.col("predicted_label")).alias("label_agrees"),
        (F.abs(total - 1) <= 0.001).alias("sums_to_one"),
    )


@query
def model_roundtrip(spark, sf_dir):
    fitted, test = _fitted(spark, sf_dir, _logistic())
    path = f"{files.scratch_dir(spark)}/model"
    model.save_model(fitted, path)
    loaded = model.load_model(path, COHORT.labels)
    before = model.predict(fitted, test).withColumnRenamed("predicted_label", "before").drop("predicted_index", "probability")
    both = model.predict(loaded, before)
    same = F.col("before").eqNullSafe(F.col("predicted_label"))
    return both.groupBy(F.col(COHORT.label).alias("actual")).agg(F.count(F.lit(1)).alias("n"), F.bool_and(same).alias("same"))


@query
def metrics_roundtrip(spark, sf_dir):
    path = files.scratch_dir(spark)
    model.write_metrics(eval_metrics(spark, sf_dir), confusion_matrix(spark, sf_dir), path)
    return model.read_metrics(spark, path)


@query
def model_card(spark, sf_dir):
    fitted, test = _fitted(spark, sf_dir, _logistic())
    metrics = model.evaluate(model.predict(fitted, test), COHORT.label, "predicted_label", COHORT.labels)
    card = model.model_card(fitted, metrics, "logistic-1", VERSION, NOW)
    return card.select(
        "model_run_id",
        "algorithm",
        F.array_join("features", ",").alias("features"),
        F.to_json("index_to_label").alias("index_to_label"),
        F.array_join(F.array_sort(F.map_keys("metrics")), ",").alias("metric_names"),
        "dataset_version",
        "trained_at",
    )
