"""Hand-written dirty rows, one per rule that is easy to get wrong."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cohortloom import PATIENT_RENAMES, PATIENTS, CohortSchema
from cohortloom import functions as X
from cohortloom.operators import cleaning, distribution, quality, risk, search

S = CohortSchema(
    id="id",
    label="level",
    labels=("Low", "Medium", "High"),
    number="age",
    category="sex",
    codes={1: "one", 2: "two"},
    ordinals=("a", "b"),
)
TEXT = "id string, age string, sex string, a string, b string, level string"
TYPED = "id string, age int, sex int, a int, b int, level string"


def rows(spark, *data, schema=TEXT):
    return spark.createDataFrame(list(data), schema)


def values(frame, column):
    return [row[column] for row in frame.collect()]


def numbers(spark, *cells):
    frame = spark.createDataFrame([(at, cell) for at, cell in enumerate(cells)], "at int, x string")
    return values(X.with_numbers(frame, ["x"]).orderBy("at"), "x")


def test_lenient_numbers(spark):
    assert numbers(spark, "19.5", "-3", " 7 ", "\t8\n", " 9", "1e2", ".5", "5.") == [
        19.5, -3.0, 7.0, 8.0, 9.0, 100.0, 0.5, 5.0,
    ]
    assert numbers(spark, "", " ", None, "abc", "7d", "7f", "0x1p3", "1_0", "nan", "inf", "-Infinity", "1e999") == [None] * 12


def test_double_columns_lose_nan_and_infinity(spark):
    frame = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (None,)], "x double")
    assert values(X.with_numbers(frame, ["x"]), "x") == [1.5, None, None, None]


def test_whole_numbers_truncate_toward_zero(spark):
    frame = spark.createDataFrame([("1.7",), ("-1.7",), ("inf",), ("9",), ("1e30",)], "x string")
    assert values(X.with_whole(frame, ["x"]), "x") == [1, -1, None, 9, None]


def test_age_bands(spark):
    frame = spark.createDataFrame([(0.0,), (19.0,), (19.5,), (-3.0,), (60.0,), (150.0,), (None,)], "x double")
    closed = values(frame.select(X.age_band(F.col("x"), S).alias("b")), "b")
    assert closed == ["<20", "<20", ">=60", ">=60", ">=60", ">=60", "N/A"]
    cut = values(frame.select(X.age_band(F.col("x"), S, "right_closed").alias("b")), "b")
    assert cut == ["<20", "<20", "20-29", None, ">=60", None, None]
    with pytest.raises(ValueError):
        X.age_band(F.col("x"), S, "other")


def test_buckets_take_out_of_scale_numbers(spark):
    frame = spark.createDataFrame([(0.0,), (3.0,), (3.5,), (6.0,), (6.7,), (12.0,), (None,)], "x double")
    expected = ["low", "low", "mid", "mid", "high", "high", None]
    assert values(frame.select(X.bucket(F.col("x"), S).alias("b")), "b") == expected
    tests = X.bucket_tests(F.col("x"), S)
    for name in S.bucket_names:
        assert [bool(hit) for hit in values(frame.select(tests[name].alias("t")), "t")] == [b == name for b in expected]


def test_labels(spark):
    frame = spark.createDataFrame(
        [("\t hIgH \n",), ("None",), (None,), ("Severe",), ("o'neil-smith",), ("　low\x1f",)], "level string"
    )
    cleaned = frame.select(X.clean_label(F.col("level"), S.labels).alias("level"))
    assert values(cleaned, "level") == ["High", "None", None, "Severe", "O'Neil-Smith", "Low"]
    code = X.encode_label(F.col("level"), S).alias("c")
    assert values(cleaned.select(code), "c") == [2, -1, -1, -1, -1, 0]
    assert values(cleaned.select(X.encode_label(F.col("level"), S, None).alias("c")), "c") == [2, None, None, None, None, 0]


def test_signature(spark):
    import hashlib

    frame = rows(
        spark, ("1", "44.0", "1", "3", "4", "Low"), ("2", "44", "1", None, "4", "Low"), ("3", "44", "1", "4", None, "Low")
    )
    expected = hashlib.sha256(b"44|1|3|4").hexdigest()
    assert values(X.with_signature(frame, S.features), "feature_signature") == [expected, None, None]
    typed = rows(spark, ("1", 44, 1, 3, 4, "Low"), schema=TYPED)
    assert values(X.with_signature(typed, S.features), "feature_signature") == [expected]


def test_row_key_tells_null_and_shifted_text_apart(spark):
    frame = spark.createDataFrame([("a", "b"), ("ab", ""), ("a", None), (None, "a"), ("-", None)], "x string, y string")
    assert frame.select(X.row_key(["x", "y"]).alias("k")).distinct().count() == 5


DIRTY = [
    ("p1", "30", "1", "2", "8", "High"),
    ("p1", "30", "1", "2", "8", "High"),
    ("p2", "30", "1", "2", "8", "low"),
    (None, "150", "3", "0", "12", "Severe"),
    (None, "abc", "", "", "5", None),
    ("p3", "25", "2", "6.7", "nan", " medium "),
]


def test_quality_summary(spark):
    got = quality.quality_summary(rows(spark, *DIRTY), S).first().asDict()
    assert got == {
        "row_count_raw": 6,
        "row_count_valid": 3,
        "row_count_invalid": 3,
        "valid_row_pct": 50.0,
        "field_completeness_pct": 90.0,
        "column_count": 5,
        "missing_cells": 3,
        "duplicate_id": 2,
        "duplicate_full_row": 1,
        "unique_feature_signature": 2,
        "duplicated_feature_rows": 4,
        "rows_without_signature": 2,
        "signature_label_conflicts": 1,
        "invalid_age": 2,
        "invalid_sex": 2,
        "invalid_risk_scale": 4,
        "invalid_level": 2,
    }


def test_quality_of_nothing(spark):
    got = quality.quality_summary(rows(spark), S).first()
    assert (got.row_count_raw, got.duplicate_id, got.valid_row_pct, got.field_completeness_pct) == (0, 0, 0.0, 0.0)


def test_missing_label_is_a_label_of_its_own_in_conflicts(spark):
    frame = rows(spark, ("1", "30", "1", "2", "8", None), ("2", "30", "1", "2", "8", "Low"))
    assert values(quality.label_conflicts(frame, S), "n_labels") == [2]
    same = rows(spark, ("1", "30", "1", "2", "8", None), ("2", "30", "1", "2", "8", "none"))
    assert quality.label_conflicts(same, S).count() == 0
    assert quality.profile(frame, S).first().signature_label_conflicts == 1


def test_row_and_cell_units(spark):
    frame = rows(spark, ("1", "30", "1", "0", "12", "Low"), ("2", "30", "1", "1", "2", "Low"))
    per_row = {row.check_name: row.n for row in quality.violation_counts(frame, S).collect()}
    assert per_row == {"rows_total": 2, "invalid_risk_scale": 1}
    report = {row.check_name: row.value for row in quality.quality_report(frame, S).collect()}
    assert report["invalid_risk_scale"] == 2
    assert quality.violation_counts(rows(spark), S).count() == 0


def test_gate(spark):
    clean = rows(spark, ("1", "30", "1", "1", "2", "Low"))
    quality.gate(quality.quality_report(clean, S))
    with pytest.raises(quality.QualityError, match="invalid_level=1"):
        quality.gate(quality.quality_report(rows(spark, ("1", "30", "1", "1", "2", "Severe")), S))


def test_checks_table(spark):
    checks = {row.name: (row["count"], row.passed) for row in
              quality.checks_table(quality.quality_summary(rows(spark, *DIRTY), S), S).collect()}
    assert len(checks) == 7
    assert checks["duplicate_full_row"] == (1, False)
    assert checks["signature_label_conflicts"] == (1, False)


def test_validation_keeps_every_row_once(spark):
    frame = rows(spark, *DIRTY)
    valid, quarantine = cleaning.validate(frame, S)
    assert valid.count() == 3 and quarantine.count() == 3
    errors = {tuple(row.errors) for row in quarantine.collect()}
    assert ("missing:id", "invalid:age", "missing:sex", "missing:a", "missing:level") in errors
    assert ("invalid:b",) in errors
    with pytest.raises(cleaning.ContractError):
        cleaning.validate(frame.drop("a"), S)


def test_score_requests_are_a_closed_set_of_whole_numbers(spark):
    frame = rows(spark, (None, "30", "1", "2", "8", "x"), ("2", "30.5", "1", "2", "8", "x")).drop("level")
    valid, quarantine = cleaning.validate(frame, S, scoring=True)
    assert values(valid, "id") == [None]
    assert values(quarantine, "errors") == [["invalid:age"]]
    with pytest.raises(cleaning.ContractError, match="level"):
        cleaning.validate(frame.withColumn("level", F.lit("Low")), S, scoring=True)


def test_three_rules_for_missing_values(spark):
    frame = rows(spark, ("1", "30", "1", "6.7", "", "Low"), ("2", "30", "1", "", "", "Low"), ("3", "3", "1", "9", "9", "x"))

    def mean(result, level="Low"):
        return {row.indicator: (row["mean"], row.n) for row in result.collect() if row.level == level}

    assert mean(risk.means_by_label(frame, S)) == {"a": (6.7, 1)}
    assert mean(risk.means_by_label(frame, S, truncate=True)) == {"a": (6.0, 1)}
    assert mean(risk.means_by_label(frame, S, missing="zero")) == {"a": (3.35, 2), "b": (0.0, 2)}
    assert mean(risk.means_by_label(frame, S, missing="zero"), "High") == {"a": (0.0, 0), "b": (0.0, 0)}
    overall = {row.indicator: (row["mean"], row.n) for row in risk.means_overall(frame, S).collect()}
    assert overall == {"a": (5.23, 3), "b": (3.0, 3)}


def test_means_round_half_up(spark):
    data = [("x", 1, 1, 0, v, "Low") for v in (5, 5, 5, 5, 3, 2, 4, 2)]
    frame = spark.createDataFrame([(i, *rest) for i, (_, *rest) in enumerate(data)], "id int, age int, sex int, a int, b int, level string")
    got = {row.indicator: row["mean"] for row in risk.means_by_label(frame, S).collect()}
    assert got["b"] == 3.88  # 31 / 8 = 3.875


def test_equal_impact_keeps_declared_order(spark):
    frame = rows(spark, ("1", 30, 1, 1, 1, "Low"), ("2", 30, 1, 9, 9, "High"), schema=TYPED)
    ranked = risk.risk_factors(frame, S).orderBy("rank").collect()
    assert [(row["rank"], row.indicator, row.impact, row.pct_high) for row in ranked] == [(1, "a", 8.0, 100.0), (2, "b", 8.0, 100.0)]
    nested = risk.factor_documents(frame, S).orderBy("rank").first()
    assert nested.mean_by_level == {"Low": 1.0, "Medium": 0.0, "High": 9.0}
    assert nested.crosstab["high"] == {"Low": 0, "Medium": 0, "High": 1}


def test_distribution_is_consistent(spark):
    frame = rows(spark, *DIRTY)
    table = {row.key: row.n for row in distribution.distribution_table(frame, S).collect()}
    assert table["level|High"] == 2 and table["level|Low"] == 1 and table["level|Medium"] == 1
    for level in ("Low", "Medium", "High"):
        for kind in ("age", "sex"):
            assert sum(n for key, n in table.items() if key.startswith(f"cross|level_{kind}|{level}|")) == table[f"level|{level}"]
    assert table["indicator|a|6.7"] == 1 and "level|Severe" not in table
    cells = risk.bucket_crosstab(frame, S).groupBy("indicator", "level").agg(F.sum("n").alias("n"))
    means = risk.means_by_label(frame, S).select("indicator", "level", "n")
    assert {tuple(row) for row in cells.collect()} == {tuple(row) for row in means.collect()}
    combined = risk.correlation_table(frame, S)
    assert combined.where("kind = 'N'").agg(F.sum("n")).first()[0] == 4


def test_filled_counts(spark):
    frame = rows(spark, ("1", "30", "1", "1", "1", "Low"))
    assert {tuple(row) for row in distribution.label_counts_filled(frame, S).collect()} == {("Low", 1), ("Medium", 0), ("High", 0)}
    assert {tuple(row) for row in distribution.category_counts_filled(frame, S).collect()} == {("one", 1), ("two", 0)}
    assert distribution.band_counts_filled(frame, S).count() == 6
    odd = rows(spark, ("1", "x", "9", "1", "1", "Low"))
    assert ("other", 1) in {tuple(row) for row in distribution.category_counts_filled(odd, S).collect()}
    assert ("N/A", 1) in {tuple(row) for row in distribution.band_counts_filled(odd, S).collect()}


def test_contract(spark):
    frame = spark.createDataFrame([(1, 2)], "a int, c int")
    with pytest.raises(cleaning.ContractError, match=r"missing columns: \['b'\]; unexpected columns: \['c'\]"):
        cleaning.require_columns(frame, ["a", "b"])
    assert cleaning.require_columns(frame, ["c", "a"]).columns == ["c", "a"]


def test_uniqueness_counts_null_as_a_value(spark):
    frame = rows(spark, *DIRTY)
    assert tuple(quality.uniqueness(frame, "id").first()) == (6, 4, False)


def test_search_allow_list(spark):
    frame = rows(spark, ("b", 30, 1, 5, 1, "Low"), ("a", 30, 1, 5, 1, "Low"), ("c", 20, 2, 9, 1, "High"), schema=TYPED)
    assert values(search.sort(search.where(frame, S, label="LOW"), S, "age", "desc"), "id") == ["a", "b"]
    assert values(search.sort(frame, S, "id", "desc"), "id") == ["c", "b", "a"]
    assert search.where(frame, S, feature="a", operator="between", min_value=6, max_value=4).count() == 2
    for wrong in (
        dict(label="Severe"),
        dict(category=3),
        dict(feature="level", operator="eq", value=1),
        dict(feature="a", operator="ne", value=1),
        dict(feature="a", operator="eq"),
        dict(feature="a", operator="between", min_value=1),
    ):
        with pytest.raises(ValueError):
            search.where(frame, S, **wrong)
    with pytest.raises(ValueError):
        search.sort(frame, S, "dropped")


def test_paging(spark):
    frame = rows(spark, *[(f"p{at:03}", 30, 1, 5, 1, "Low") for at in range(250)], schema=TYPED)
    order = search.sort_columns(S)
    pages = [values(search.page_rows(frame, order, page, 100), "id") for page in (1, 2, 3)]
    assert [len(page) for page in pages] == [100, 100, 50]
    assert sum(pages, []) == [f"p{at:03}" for at in range(250)]
    assert tuple(search.page_meta(frame, 0, 100).first()) == (1, 100, 250, 3)
    assert tuple(search.page_meta(frame, 0, 500).first()) == (1, 500, 250, 1)
    assert search.page_meta(frame.limit(0)).first().total_pages == 1


@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_walking_all_pages_is_the_sorted_table(spark, direction):
    frame = rows(spark, *[(f"p{at:02}", None if at % 5 == 0 else at % 3, 1, 5, 1, "Low") for at in range(40)], schema=TYPED)
    keys, seen, last = search.sort_keys(S, "age", direction), [], None
    while page := search.page_after(frame, keys, last, 7).collect():
        seen += [row.id for row in page]
        last = page[-1].asDict()
    assert seen == values(search.sort(frame, S, "age", direction), "id")
    twice = frame.unionByName(frame)
    with pytest.raises(ValueError, match="repeat"):
        search.page_after(twice, keys, twice.first().asDict(), 5)


def test_history(spark):
    log = spark.createDataFrame(
        [("1", "a", "High", datetime(2024, 1, 1)), ("2", "a", "Low", datetime(2024, 1, 2)), ("3", "a", "High", datetime(2024, 1, 2))],
        "prediction_id string, subject_id string, predicted_label string, created_at timestamp_ntz",
    )
    assert values(search.page_rows(search.history(log, subject="a"), search.newest_first()), "prediction_id") == ["2", "3", "1"]
    assert search.history(log, predicted="HIGH", labels=S.labels).count() == 2
    assert search.history(log, predicted="HIGH").count() == 0


def test_export_is_whole_without_a_limit(spark):
    frame = rows(spark, *DIRTY)
    assert search.export_rows(frame.withColumn("age", F.lit(3)), S).count() == len(DIRTY)
    assert search.export_rows(frame.withColumn("age", F.lit(3)), S, limit=2).count() == 2


def test_verify(spark):
    stored = cleaning.enrich(rows(spark, *DIRTY[2:3]), S, "v1", datetime(2024, 1, 1))
    expected = spark.createDataFrame([("total", 1), ("level:Low", 1), ("level:Medium", 0), ("level:High", 1)], "check_name string, expected bigint")
    checks = {row.check_name: row.ok for row in quality.verify(stored, S, expected, raw_names=["age"]).collect()}
    assert checks["total"] and checks["unique_id"] and checks["signature"] and checks["level:Low"]
    assert not checks["level:High"] and not checks["raw_case_columns"] and not checks["sex:1"]


def test_patient_preset():
    assert len(PATIENT_RENAMES) == 25
    assert len(PATIENTS.features) == 23 and len(PATIENTS.ordinals) == 21
    assert PATIENTS.features[:3] == ("age", "gender", "air_pollution") and PATIENTS.features[-1] == "snoring"


def test_patient_pipeline(spark):
    sheet = spark.createDataFrame(
        [(f" P{at} ", "33", "1", *[str(1 + at % 9)] * 21, "low" if at % 2 else "HIGH") for at in range(18)],
        ", ".join(f"`{name}` string" for name in PATIENT_RENAMES),
    )
    canonical = cleaning.canonicalize(cleaning.require_columns(sheet, list(PATIENT_RENAMES)), PATIENT_RENAMES)
    stored = cleaning.enrich(canonical, PATIENTS, "v1", datetime(2024, 1, 1))
    assert stored.where("length(feature_signature) = 64 and age_group = '30-39'").count() == 18
    assert risk.risk_factors(stored, PATIENTS).count() == 21
    assert quality.quality_summary(stored, PATIENTS).first().row_count_valid == 18


def test_verify_reports_what_is_missing(spark):
    stored = cleaning.enrich(rows(spark, *DIRTY[2:3]), S, "v1", datetime(2024, 1, 1)).drop(S.label)
    expected = spark.createDataFrame([("total", 1), (f"{S.label}:Severe", 3)], "check_name string, expected bigint")
    checks = {row.check_name: row for row in quality.verify(stored, S, expected).collect()}
    assert not checks["missing_columns"].ok and checks["missing_columns"].measured == 1
    assert not checks[f"{S.label}:Severe"].ok and checks["total"].ok
