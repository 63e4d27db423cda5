"""DuckDB SQL that says independently what each query has to return.

Every statement starts from the binding it needs as a common table expression
and runs over the whole table.
"""

from __future__ import annotations

import re

from cohortloom.plans import bindings as B
from cohortloom.plans.bindings import COHORT, RAW
from cohortloom.plans.queries import EXPECTED_COLUMNS, NOW, RENAMES, VERSION
from cohortloom.schema import CohortSchema

RATIO = "CAST(0.7 AS DOUBLE)"
NOW_SQL = f"TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}'"


def _tables(sql: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", sql).replace("TIMESTAMP_NTZ", "TIMESTAMP").strip()


def _with(ctes: dict[str, str], body: str) -> str:
    listed = ", ".join(f"{name} AS ({sql.strip()})" for name, sql in ctes.items())
    return f"WITH {listed} {body.strip()}"


def _num(name: str) -> str:
    """A cell as a finite number; 1_0 and the like are none here."""
    cell = f"TRY_CAST(trim({name}, ' ' || chr(9)) AS DOUBLE)"
    return f"CASE WHEN isfinite({cell}) AND NOT regexp_matches({name}, '[_xXdDfF]') THEN {cell} END"


def _label(name: str) -> str:
    return f"CASE lower(trim({name})) WHEN 'low' THEN 'Low' WHEN 'medium' THEN 'Medium' WHEN 'high' THEN 'High' END"


def _title(name: str) -> str:
    return f"upper(trim({name})[1]) || lower(trim({name})[2:])"


def _closed(age: str) -> str:
    return f"""CASE WHEN {age} IS NULL THEN 'N/A' WHEN {age} >= 0 AND {age} <= 19 THEN '<20'
      WHEN {age} >= 20 AND {age} <= 29 THEN '20-29' WHEN {age} >= 30 AND {age} <= 39 THEN '30-39'
      WHEN {age} >= 40 AND {age} <= 49 THEN '40-49' WHEN {age} >= 50 AND {age} <= 59 THEN '50-59' ELSE '>=60' END"""


def _cut(age: str) -> str:
    return f"""CASE WHEN {age} < 0 OR {age} > 120 OR {age} IS NULL THEN NULL WHEN {age} <= 19 THEN '<20'
      WHEN {age} <= 29 THEN '20-29' WHEN {age} <= 39 THEN '30-39' WHEN {age} <= 49 THEN '40-49'
      WHEN {age} <= 59 THEN '50-59' ELSE '>=60' END"""


def _bucket(value: str) -> str:
    return f"CASE WHEN {value} <= 3 THEN 'low' WHEN {value} <= 6 THEN 'mid' WHEN {value} > 6 THEN 'high' END"


def _signature(schema: CohortSchema, numbers: str = "{0}") -> str:
    joined = " || '|' || ".join(
        f"CAST(CAST(trunc({numbers.format(name)}) AS BIGINT) AS VARCHAR)" for name in schema.features
    )
    return f"sha256({joined})"


COHORT_CTE = {"cohort": _tables(B.COHORT_SQL)}
RAW_CTE = {"damaged": _tables(B.RAW_SQL)}
_RAW_NUMBERS = ", ".join(f"{_num(name)} AS {name}" for name in RAW.features)
CLEAN_CTE = {
    **RAW_CTE,
    "clean": f"""SELECT trim(subject_id) AS subject_id, {_RAW_NUMBERS},
        coalesce({_label('level')}, {_title('level')}) AS level FROM damaged""",
}
SIGNED_CTE = {
    **CLEAN_CTE,
    "signed": f"SELECT *, {_signature(RAW)} AS feature_signature, coalesce(level, 'None') AS stated FROM clean",
}
GROUPED_CTE = {
    "bound": _tables(B.GROUPED_SQL),
    "grouped": "SELECT row_id, sha256(group_text) AS feature_signature, label FROM bound",
}
ORDERED_CTE = {
    **GROUPED_CTE,
    "pairs": "SELECT DISTINCT feature_signature, label FROM grouped",
    "ranked": """SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY sha256(feature_signature || '42')) AS BIGINT) AS rn,
        count(*) OVER (PARTITION BY label) AS group_count FROM pairs""",
    "sides": f"""SELECT feature_signature, CASE WHEN rn <= greatest(1, least(group_count - 1, round(group_count * {RATIO})))
        THEN 'train' ELSE 'test' END AS split FROM ranked""",
    "divided": "SELECT g.row_id, g.feature_signature, g.label, s.split FROM grouped g LEFT JOIN sides s USING (feature_signature)",
}
SKEWED_CTE = {
    "bound": _tables(B.GROUPED_SQL),
    "skewed": """SELECT row_id, CASE WHEN row_id % 7 <> 0 THEN sha256(CASE WHEN row_id % 3 = 0 THEN 'everyone' ELSE group_text END) END AS signature, label
        FROM bound""",
}
LOG_CTE = {"log": _tables(B.HISTORY_SQL)}
JUDGED_CTE = {"judged": _tables(B.JUDGED_SQL)}
CLASSES_CTE = {
    **JUDGED_CTE,
    "classes": """SELECT label,
        (SELECT count(*) FROM judged WHERE actual = label) AS support,
        (SELECT count(*) FROM judged WHERE predicted = label) AS called,
        (SELECT count(*) FROM judged WHERE actual = label AND predicted = label) AS hits
        FROM (VALUES ('A'), ('N'), ('R')) v(label)""",
    "rates": """SELECT label, support, CASE WHEN called > 0 THEN hits / called ELSE 0 END AS "precision",
        CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall,
        CASE WHEN called + support > 0 THEN 2.0 * hits / (called + support) ELSE 0 END AS f1 FROM classes""",
}


def _long(schema: CohortSchema, source: str, value: str, keep: str = "level") -> str:
    """One row per (row, indicator) with the schema position."""
    return " UNION ALL ".join(
        f"SELECT {keep}, {at} AS position, '{name}' AS indicator, {value.format(name)} AS v FROM {source}"
        for at, name in enumerate(schema.ordinals)
    )


def _keys(source: str, schema: CohortSchema, text: str) -> str:
    """Distribution keys, one row per emitted pair."""
    parts = [
        f"SELECT 'level|' || level AS key FROM {source}",
        f"SELECT 'gender|' || gender FROM {source}",
        f"SELECT 'age_group|' || age_group FROM {source}",
        f"SELECT 'cross|level_age|' || level || '|' || age_group FROM {source}",
        f"SELECT 'cross|level_gender|' || level || '|' || gender FROM {source}",
    ]
    for name in schema.ordinals:
        shown = text.format(name)
        parts.append(f"SELECT 'indicator|{name}|' || {shown} FROM {source} WHERE {shown} <> ''")
    return " UNION ALL ".join(parts)


DIMENSIONS_CTE = {
    **RAW_CTE,
    "dims": f"""SELECT {_label('level')} AS level, trim(gender) AS gender, {_closed(_num('age'))} AS age_group,
        {', '.join(RAW.ordinals)} FROM damaged WHERE {_label('level')} IS NOT NULL""",
}
COHORT_KEYS_CTE = {
    **COHORT_CTE,
    "dims": f"""SELECT level, CAST(gender AS VARCHAR) AS gender, {_closed('age')} AS age_group,
        {', '.join(f'CAST({name} AS VARCHAR) AS {name}' for name in COHORT.ordinals)} FROM cohort""",
    "keys": _keys("dims", COHORT, "{0}"),
    "counted": "SELECT key, count(*) AS n FROM keys GROUP BY key",
}


def _risk(schema: CohortSchema, ctes: dict[str, str], source: str, value: str) -> dict[str, str]:
    """Risk table: `ranked` holds one row per indicator."""
    labels, buckets = schema.labels, schema.bucket_names
    means = ", ".join(
        f"coalesce(round(sum(v) FILTER (level = '{lb}') / count(v) FILTER (level = '{lb}'), 2), 0.0) AS mean_{lb.lower()}"
        for lb in labels
    )
    cells = ", ".join(
        f"count(*) FILTER (level = '{lb}' AND bucket = '{bk}') AS {bk}_{lb.lower()}" for bk in buckets for lb in labels
    )
    return {
        **ctes,
        "long": _long(schema, source, value),
        "placed": f"SELECT *, {_bucket('v')} AS bucket FROM long WHERE level IN ('Low', 'Medium', 'High')",
        "factors": f"SELECT position, indicator, {means}, {cells} FROM placed GROUP BY position, indicator",
        "scored": """SELECT *, round(mean_high - mean_low, 2) AS impact,
            CASE WHEN high_low + high_medium + high_high > 0
                 THEN round(high_high / (high_low + high_medium + high_high) * 100, 1) ELSE 0.0 END AS pct_high
            FROM factors""",
        "ranked": """SELECT *, CAST(row_number() OVER (ORDER BY impact DESC, position) AS INTEGER) AS "rank" FROM scored""",
    }


COHORT_RISK = _risk(COHORT, COHORT_CTE, "cohort", "CAST({0} AS BIGINT)")
RAW_RISK = _risk(RAW, CLEAN_CTE, "clean", "{0}")
TRUNCATED_CTE = {
    **CLEAN_CTE,
    "labelled": "SELECT * FROM clean WHERE level IN ('Low', 'Medium', 'High')",
    "long": _long(RAW, "labelled", "CAST(trunc({0}) AS BIGINT)"),
    "placed": f"SELECT *, {_bucket('v')} AS bucket FROM long WHERE v IS NOT NULL",
}

_bad_cells = " + ".join(f"CAST(NOT coalesce({name} BETWEEN 1 AND 9, false) AS INTEGER)" for name in RAW.ordinals)
_blank_cells = " + ".join(f"CAST(coalesce(trim({name}), '') = '' AS INTEGER)" for name in RAW.checked)
AUDIT_CTE = {
    **SIGNED_CTE,
    "cells": f"""SELECT CAST(NOT coalesce(age BETWEEN 0 AND 120, false) AS INTEGER) AS bad_age,
        CAST(NOT coalesce(gender IN (1, 2), false) AS INTEGER) AS bad_gender,
        CAST(NOT coalesce(level IN ('Low', 'Medium', 'High'), false) AS INTEGER) AS bad_level,
        {_bad_cells} AS bad_cells,
        CAST(age IS NULL AS INTEGER) + CAST(gender IS NULL AS INTEGER) + {' + '.join(f'CAST({n} IS NULL AS INTEGER)' for n in RAW.ordinals)}
          + CAST(level IS NULL AS INTEGER) AS empty_cells, subject_id FROM clean""",
    "per_signature": """SELECT feature_signature, count(*) AS n, count(DISTINCT stated) AS n_labels FROM signed
        WHERE feature_signature IS NOT NULL GROUP BY 1""",
    "repeats": f"SELECT count(*) AS n FROM damaged GROUP BY {', '.join(RAW.checked)}",
    "ids": "SELECT count(*) AS n FROM damaged GROUP BY subject_id",
    "summary": f"""SELECT (SELECT count(*) FROM damaged) AS row_count_raw,
        (SELECT count(*) FROM cells WHERE bad_age + bad_gender + bad_level + bad_cells = 0) AS row_count_valid,
        (SELECT CAST(sum({_blank_cells}) AS BIGINT) FROM damaged) AS missing_cells,
        (SELECT CAST(sum(n - 1) AS BIGINT) FROM ids) AS duplicate_id,
        (SELECT CAST(sum(n - 1) AS BIGINT) FROM repeats) AS duplicate_full_row,
        (SELECT count(*) FROM per_signature) AS unique_feature_signature,
        (SELECT count(*) FROM signed WHERE feature_signature IS NULL) AS rows_without_signature,
        (SELECT count(*) FROM per_signature WHERE n_labels > 1) AS signature_label_conflicts,
        (SELECT CAST(sum(bad_age) AS BIGINT) FROM cells) AS invalid_age,
        (SELECT CAST(sum(bad_gender) AS BIGINT) FROM cells) AS invalid_gender,
        (SELECT CAST(sum(bad_cells) AS BIGINT) FROM cells) AS invalid_risk_scale,
        (SELECT CAST(sum(bad_level) AS BIGINT) FROM cells) AS invalid_level""",
}
REPORT_CTE = {
    **AUDIT_CTE,
    "report": f"""
        SELECT 'invalid_gender' AS check_name, CAST(sum(bad_gender) AS BIGINT) AS "value" FROM cells
        UNION ALL SELECT 'invalid_age', CAST(sum(bad_age) AS BIGINT) FROM cells
        UNION ALL SELECT 'invalid_risk_scale', CAST(sum(bad_cells) AS BIGINT) FROM cells
        UNION ALL SELECT 'invalid_level', CAST(sum(bad_level) AS BIGINT) FROM cells
        UNION ALL SELECT 'row_count', count(*) FROM cells
        UNION ALL SELECT 'column_count_clean', {len(RAW.checked) + 1}
        UNION ALL SELECT 'missing_total', CAST(sum(empty_cells) AS BIGINT) + count(*) FILTER (subject_id IS NULL) FROM cells
        UNION ALL SELECT 'duplicated_subject_id', count(*) - count(DISTINCT subject_id) - CAST(bool_or(subject_id IS NULL) AS BIGINT) FROM cells""",
}


def _errors() -> str:
    rules = {"age": "age BETWEEN 0 AND 120", "gender": "gender IN (1, 2)"}
    rules.update({name: f"{name} BETWEEN 1 AND 9" for name in RAW.ordinals})
    parts = ["CASE WHEN coalesce(trim(d.subject_id), '') = '' THEN 'missing:subject_id' END"]
    for name, rule in rules.items():
        checked = rule.replace(name, _num(f"d.{name}"), 1)
        parts.append(
            f"CASE WHEN coalesce(trim(d.{name}), '') = '' THEN 'missing:{name}' WHEN NOT coalesce({checked}, false) THEN 'invalid:{name}' END"
        )
    parts.append(
        f"CASE WHEN coalesce(trim(d.level), '') = '' THEN 'missing:level' WHEN {_label('d.level')} IS NULL THEN 'invalid:level' END"
    )
    return f"concat_ws(',', {', '.join(parts)})"


VALIDATED_CTE = {**RAW_CTE, "validated": f"SELECT d.*, {_errors()} AS errors FROM damaged d"}
STORE_CTE = {
    "target": _tables(B.STORE_SQL),
    "arrivals": _tables(B.BATCH_SQL),
    "fresh": """SELECT * FROM arrivals QUALIFY row_number() OVER
        (PARTITION BY id ORDER BY updated_at DESC, amount DESC, note DESC) = 1""",
}
_cohort_columns = ", ".join([COHORT.id, *COHORT.features, COHORT.label])
_contract = " UNION ALL ".join(
    f"""SELECT '{'matched' if name in (RAW.id, *RAW.checked) else 'missing'}' AS kind, '{name}' AS "column",
        {f'count({name})' if name in (RAW.id, *RAW.checked) else 'count(NULL)'} AS n_values FROM damaged"""
    for name in EXPECTED_COLUMNS
) + "".join(
    f" UNION ALL SELECT 'unexpected', '{name}', count({name}) FROM damaged"
    for name in (RAW.id, *RAW.checked)
    if name not in EXPECTED_COLUMNS
)
_dims = lambda *columns: _with(
    DIMENSIONS_CTE, f"SELECT {', '.join(columns)}, count(*) AS n FROM dims GROUP BY {', '.join(columns)}"
)
_zero = {**CLEAN_CTE, "labelled": "SELECT * FROM clean WHERE level IN ('Low', 'Medium', 'High')"}
_zero["long"] = _long(RAW, "labelled", "coalesce({0}, 0)")
_filled = """SELECT v.{0}, (SELECT count(*) FROM bucketed b WHERE b.x = v.{0}) AS n
    FROM (VALUES {1}) v({0}, always)
    WHERE always OR EXISTS (SELECT 1 FROM bucketed b WHERE b.x = v.{0})"""


def _side_groups(rows: str) -> str:
    return f"""SELECT count(*) FILTER (in_test) AS test_groups, count(*) FILTER (in_test AND in_train) AS shared_groups
        FROM (SELECT feature_signature, bool_or(split = 'test') AS in_test, bool_or(split = 'train') AS in_train
              FROM {rows} GROUP BY 1)"""


SNAPSHOT = f"SELECT {NOW_SQL} AS created_at, split_part(key, '|', 1) AS section, key, n FROM counted"

# The test side of the cohort by its signatures, as the split has to give it.
SIDES_CTE = {
    "cohort": _tables(B.MODEL_SQL),
    "signed": f"SELECT cohort.*, {_signature(COHORT)} AS feature_signature FROM cohort",
    "ranked": """SELECT *, row_number() OVER (PARTITION BY level ORDER BY sha256(feature_signature || '42')) AS rn,
        count(*) OVER (PARTITION BY level) AS group_count FROM (SELECT DISTINCT feature_signature, level FROM signed)""",
    "held": f"SELECT feature_signature FROM ranked WHERE rn > greatest(1, least(group_count - 1, round(group_count * {RATIO})))",
}
TESTED_CTE = {**SIDES_CTE, "tested": "SELECT level FROM signed SEMI JOIN held USING (feature_signature)"}
TRAINED_CTE = {**SIDES_CTE, "trained": "SELECT * FROM signed ANTI JOIN held USING (feature_signature)"}


def _prefixed(name: str) -> str:
    return f"CAST(length(CAST({name} AS VARCHAR)) AS VARCHAR) || ':' || CAST({name} AS VARCHAR)"


ORACLES: dict[str, str] = {
    "read_clean_rows": _with(COHORT_CTE, "SELECT * FROM cohort"),
    "positional_bad_rows": _with(
        COHORT_CTE,
        """SELECT 'good' AS kind, count(*) AS n FROM cohort WHERE age NOT IN (13, 17, 29)
        UNION ALL SELECT 'bad', count(*) FROM cohort WHERE age IN (13, 17, 29)""",
    ),
    "split_manifest_roundtrip": _with(ORDERED_CTE, "SELECT * FROM divided"),
    "counts_parse": _with(COHORT_KEYS_CTE, "SELECT split_part(key, '|', 1) AS section, key, n FROM counted"),
    "clean_outputs_roundtrip": _with(
        CLEAN_CTE,
        f"""SELECT subject_id, {', '.join(RAW.features)},
        CAST(CASE level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 END AS INTEGER) AS level_encoded, level FROM clean""",
    ),
    "export_rows": _with(COHORT_CTE, f"SELECT {_cohort_columns} FROM cohort WHERE level = 'High' AND ind_qty >= 6"),
    "risk_export_wide": _with(
        COHORT_RISK,
        'SELECT "rank", indicator, mean_low, mean_medium, mean_high, impact, pct_high AS pct_high_when_high_value FROM ranked',
    ),
    "upsert_merge": _with(
        STORE_CTE,
        f"""SELECT coalesce(t.id, f.id) AS id,
        CASE WHEN f.here THEN f.amount ELSE t.amount END AS amount,
        CASE WHEN f.here THEN f.note ELSE t.note END AS note,
        CASE WHEN f.here THEN f.updated_at ELSE t.updated_at END AS updated_at,
        CASE WHEN t.created_at IS NULL THEN {NOW_SQL} ELSE t.created_at END AS created_at
        FROM target t FULL OUTER JOIN (SELECT *, TRUE AS here FROM fresh) f ON t.id IS NOT DISTINCT FROM f.id""",
    ),
    "upsert_counts": _with(
        STORE_CTE,
        """SELECT count(*) AS total, count(*) FILTER (t.created_at IS NULL) AS inserted, count(t.created_at) AS matched,
        count(*) FILTER (t.created_at IS NOT NULL AND (t.amount, t.note, t.updated_at) IS DISTINCT FROM (f.amount, f.note, f.updated_at)) AS modified
        FROM fresh f LEFT JOIN target t ON t.id IS NOT DISTINCT FROM f.id""",
    ),
    "ingest_chain": _with(
        {**SIGNED_CTE, "loaded": "SELECT *, CAST(split_part(subject_id, '-', 2) AS INTEGER) AS line FROM signed"},
        f"""SELECT subject_id, {', '.join(f'CAST(trunc({n}) AS INTEGER) AS {n}' for n in RAW.features)}, level,
        {_closed('trunc(age)')} AS age_group,
        CAST(CASE level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE -1 END AS INTEGER) AS level_encoded,
        feature_signature, CASE WHEN line >= 3 THEN '{VERSION}' ELSE 'v20240115' END AS dataset_version,
        CASE WHEN line >= 3 THEN {NOW_SQL} ELSE TIMESTAMP '2024-01-15 12:00:00' END AS updated_at,
        CASE WHEN line > 4 THEN {NOW_SQL} ELSE TIMESTAMP '2024-01-15 12:00:00' END AS created_at FROM loaded WHERE line IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY subject_id ORDER BY {', '.join(f'trunc({n}) DESC NULLS LAST' for n in RAW.features)},
        level DESC NULLS LAST, age_group DESC NULLS LAST, level_encoded DESC, feature_signature DESC NULLS LAST) = 1""",
    ),
    "distribution_snapshot": _with(COHORT_KEYS_CTE, SNAPSHOT),
    "result_document": _with(
        COHORT_RISK,
        """SELECT r.name, "rank", indicator, impact, pct_high AS pct_high_when_high_value, mean_low, mean_medium, mean_high,
        TIMESTAMP '2024-01-15 12:00:00' AS created_at FROM ranked, (VALUES ('risk', 1000), ('other', 1)) r(name, most) WHERE "rank" <= r.most""",
    ),
    "version_registry": f"""SELECT 'v20240101' AS version, count(*) AS n_rows, TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM orders
        UNION ALL SELECT '{VERSION}', count(*), {NOW_SQL} FROM lineitem""",
    "schema_contract": _with(RAW_CTE, _contract),
    "canonical_rename": f"SELECT {', '.join(f'{old} AS {new}' for old, new in RENAMES.items())} FROM orders",
    "clean_labels": _with(CLEAN_CTE, "SELECT subject_id, level FROM clean"),
    "coerce_numeric": _with(RAW_CTE, f"SELECT subject_id, {_RAW_NUMBERS} FROM damaged"),
    "to_int_truncate": _with(
        RAW_CTE,
        f"SELECT subject_id, {', '.join(f'CAST(trunc({_num(n)}) AS INTEGER) AS {n}' for n in RAW.features)} FROM damaged",
    ),
    "age_band_closed": _with(RAW_CTE, f"SELECT subject_id, age, {_closed(_num('age'))} AS age_group FROM damaged"),
    "age_band_cut": _with(RAW_CTE, f"SELECT subject_id, age, {_cut(_num('age'))} AS age_group FROM damaged"),
    "encode_label": _with(
        CLEAN_CTE,
        """SELECT subject_id, CAST(CASE level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE -1 END AS INTEGER) AS level_encoded,
        CAST(CASE level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 END AS INTEGER) AS level_encoded_or_null FROM clean""",
    ),
    "feature_signature": _with(RAW_CTE, f"SELECT subject_id, {_signature(RAW, _num('{0}'))} AS feature_signature FROM damaged"),
    "bucket_ordinals": _with(
        CLEAN_CTE,
        f"SELECT d.subject_id, {', '.join(f'{_bucket(_num(n))} AS {n}' for n in RAW.ordinals)} FROM damaged d",
    ),
    "enrich_rows": _with(
        SIGNED_CTE,
        f"""SELECT subject_id, {', '.join(f'CAST(trunc({n}) AS INTEGER) AS {n}' for n in RAW.features)}, level,
        {_closed('trunc(age)')} AS age_group,
        CAST(CASE level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE -1 END AS INTEGER) AS level_encoded,
        feature_signature, '{VERSION}' AS dataset_version, {NOW_SQL} AS updated_at FROM signed""",
    ),
    "published_frames": _with(
        CLEAN_CTE,
        f"""SELECT 'counting' AS frame, subject_id, {', '.join(RAW.features)}, {_cut('age')} AS age_group, level,
            CAST(NULL AS INTEGER) AS level_encoded FROM clean
        UNION ALL SELECT 'model', subject_id, {', '.join(RAW.features)}, NULL, level,
            CAST(CASE level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 END AS INTEGER) FROM clean""",
    ),
    "decode_category": _with(
        RAW_CTE,
        f"SELECT subject_id, CASE {_num('gender')} WHEN 1 THEN 'male' WHEN 2 THEN 'female' ELSE 'other' END AS gender_name FROM damaged",
    ),
    "search_eq": _with(COHORT_CTE, "SELECT * FROM cohort WHERE ind_part = 4"),
    "search_gte": _with(COHORT_CTE, "SELECT * FROM cohort WHERE ind_price >= 5"),
    "search_lte": _with(COHORT_CTE, "SELECT * FROM cohort WHERE ind_tax <= 3"),
    "search_between": _with(COHORT_CTE, "SELECT * FROM cohort WHERE ind_qty BETWEEN 3 AND 5"),
    "search_between_reversed": _with(COHORT_CTE, "SELECT * FROM cohort WHERE ind_qty >= 3 AND ind_qty <= 5"),
    "search_combined": _with(
        COHORT_CTE,
        "SELECT * FROM cohort WHERE level = 'High' AND gender = 1 AND age BETWEEN 36 AND 48 AND ind_price BETWEEN 3 AND 7",
    ),
    "lookup_by_id": _with(
        COHORT_CTE,
        f"""SELECT cohort.*, {_closed('age')} AS age_group,
        CAST(CASE level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE -1 END AS INTEGER) AS level_encoded,
        {_signature(COHORT)} AS feature_signature, '{VERSION}' AS dataset_version, {NOW_SQL} AS updated_at
        FROM cohort WHERE subject_id = '7-1'""",
    ),
    "validate_valid": _with(VALIDATED_CTE, "SELECT * EXCLUDE (errors) FROM validated WHERE errors = ''"),
    "validate_quarantine": _with(VALIDATED_CTE, "SELECT * FROM validated WHERE errors <> ''"),
    "prediction_history": _with(LOG_CTE, "SELECT * FROM log WHERE subject_id = '42' AND predicted_label = 'purchase'"),
    "search_sorted": _with(COHORT_CTE, "SELECT * FROM cohort WHERE level = 'Medium'"),
    "page_rows": _with(LOG_CTE, "SELECT * FROM log ORDER BY created_at DESC, prediction_id LIMIT 50 OFFSET 100"),
    "page_next": _with(
        COHORT_CTE,
        "SELECT * FROM cohort WHERE level = 'Medium' ORDER BY ind_price DESC, subject_id LIMIT 50 OFFSET 100",
    ),
    "page_meta": _with(
        LOG_CTE,
        """SELECT 1 AS page, 500 AS page_size, count(*) AS total, CAST(greatest(1, ceil(count(*) / 500)) AS BIGINT) AS total_pages
        FROM log WHERE predicted_label = 'click'""",
    ),
    "latest_snapshot": _with(COHORT_KEYS_CTE, SNAPSHOT),
    "split_assign": _with(ORDERED_CTE, "SELECT * FROM divided"),
    "attach_assignment": _with(
        SKEWED_CTE,
        """SELECT row_id, signature AS feature_signature, label, n_labels FROM skewed LEFT JOIN
        (SELECT signature, count(DISTINCT label) AS n_labels FROM skewed GROUP BY signature) USING (signature)""",
    ),
    "keep_wanted_groups": _with(
        SKEWED_CTE,
        """SELECT row_id, signature AS feature_signature, label FROM skewed WHERE signature IN
        (SELECT signature FROM skewed JOIN orders ON row_id = o_orderkey WHERE o_orderpriority = '1-URGENT' AND signature IS NOT NULL)""",
    ),
    "rows_in_train_groups": _with(ORDERED_CTE, "SELECT row_id, feature_signature, label FROM divided WHERE split = 'train'"),
    "split_overlap": _with(
        ORDERED_CTE,
        """SELECT count(*) AS overlap FROM (SELECT feature_signature FROM divided WHERE split = 'train'
        INTERSECT SELECT feature_signature FROM divided WHERE split = 'test')""",
    ),
    "distinct_groups": _with(GROUPED_CTE, "SELECT DISTINCT feature_signature, label FROM grouped"),
    "id_uniqueness": _with(
        COHORT_CTE,
        "SELECT count(*) AS total, count(DISTINCT subject_id) AS distinct_keys, count(*) = count(DISTINCT subject_id) AS is_unique FROM cohort",
    ),
    "duplicate_full_rows": _with(
        COHORT_CTE,
        f"SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM cohort GROUP BY {', '.join(COHORT.checked)})",
    ),
    "dist_level": _dims("level"),
    "dist_gender": _dims("gender"),
    "dist_age_group": _dims("age_group"),
    "dist_level_age": _dims("level", "age_group"),
    "dist_level_gender": _dims("level", "gender"),
    "dist_indicator_values": _with(
        {**DIMENSIONS_CTE, "long": _long(RAW, "dims", "trim({0})")},
        'SELECT indicator, v AS "value", count(*) AS n FROM long WHERE v <> \'\' GROUP BY ALL',
    ),
    "distribution_long": _with(
        {**DIMENSIONS_CTE, "keys": _keys("dims", RAW, "trim({0})")},
        "SELECT key, count(*) AS n FROM keys GROUP BY key",
    ),
    "stats_level_filled": _with(
        {**CLEAN_CTE, "bucketed": "SELECT level AS x FROM clean"},
        _filled.format("level", "('Low', true), ('Medium', true), ('High', true)"),
    ),
    "stats_gender_filled": _with(
        {
            **CLEAN_CTE,
            "bucketed": "SELECT CASE gender WHEN 1 THEN 'male' WHEN 2 THEN 'female' ELSE 'other' END AS x FROM clean",
        },
        _filled.format("gender", "('male', true), ('female', true), ('other', false)"),
    ),
    "stats_age_filled": _with(
        {**CLEAN_CTE, "bucketed": f"SELECT {_closed('age')} AS x FROM clean"},
        _filled.format("age_group", ", ".join([*(f"('{b}', true)" for b in RAW.band_names), "('N/A', false)"])),
    ),
    "level_share": _with(
        CLEAN_CTE, "SELECT level, count(*) AS n, round(count(*) / (SELECT count(*) FROM clean), 4) AS ratio FROM clean GROUP BY level"
    ),
    "crosstab_age_level": _with(
        CLEAN_CTE,
        f"""SELECT {_cut('age')} AS age_group, {', '.join(f"count(*) FILTER (level = '{lb}') AS {lb}" for lb in RAW.labels)}
        FROM clean WHERE {_cut('age')} IS NOT NULL GROUP BY 1""",
    ),
    "crosstab_indicator_level": _with(
        CLEAN_CTE,
        f"""SELECT ind_qty, {', '.join(f"count(*) FILTER (level = '{lb}') AS {lb}" for lb in RAW.labels)}
        FROM clean WHERE ind_qty IS NOT NULL GROUP BY 1""",
    ),
    "risk_means": _with(
        TRUNCATED_CTE, "SELECT indicator, level, round(sum(v) / count(v), 2) AS mean, count(v) AS n FROM placed GROUP BY ALL"
    ),
    "risk_crosstab": _with(TRUNCATED_CTE, "SELECT indicator, bucket, level, count(*) AS n FROM placed GROUP BY ALL"),
    "risk_n_by_level": _with(TRUNCATED_CTE, "SELECT level, count(*) AS n FROM labelled GROUP BY ALL"),
    "correlation_long": _with(
        TRUNCATED_CTE,
        """SELECT 'MEAN' AS kind, indicator, CAST(NULL AS VARCHAR) AS bucket, level, round(sum(v) / count(v), 2) AS mean, count(v) AS n
            FROM placed GROUP BY indicator, level
        UNION ALL SELECT 'XTAB', indicator, bucket, level, NULL, count(*) FROM placed GROUP BY indicator, bucket, level
        UNION ALL SELECT 'N', NULL, NULL, level, NULL, count(*) FROM labelled GROUP BY level""",
    ),
    "stats_avg_by_level": _with(
        _zero, "SELECT indicator, level, round(sum(v) / count(*), 2) AS mean, count(*) AS n FROM long GROUP BY indicator, level"
    ),
    "stats_avg_overall": _with(
        {**CLEAN_CTE, "long": _long(RAW, "clean", "coalesce({0}, 0)")},
        "SELECT indicator, round(sum(v) / count(*), 2) AS mean, count(*) AS n FROM long GROUP BY indicator",
    ),
    "stats_chart_subset": _with(
        _zero,
        """SELECT indicator, level, round(sum(v) / count(*), 2) AS mean, count(*) AS n FROM long
        WHERE indicator = 'ind_qty' GROUP BY indicator, level""",
    ),
    "risk_impact": _with(COHORT_RISK, "SELECT indicator, impact FROM ranked"),
    "risk_pct_high": _with(RAW_RISK, "SELECT indicator, pct_high FROM ranked"),
    "risk_rank": _with(COHORT_RISK, 'SELECT "rank", indicator, impact FROM ranked'),
    "risk_top_k": _with(COHORT_RISK, 'SELECT "rank", indicator, impact FROM ranked WHERE "rank" <= 5'),
    "risk_factors": _with(COHORT_RISK, "SELECT * EXCLUDE (position) FROM ranked"),
    "quality_summary": _with(
        AUDIT_CTE,
        f"""SELECT *, row_count_raw - row_count_valid AS row_count_invalid,
        round(row_count_valid / row_count_raw * 100, 2) AS valid_row_pct,
        round((row_count_raw * {len(RAW.checked)} - missing_cells) / (row_count_raw * {len(RAW.checked)}) * 100, 2) AS field_completeness_pct,
        {len(RAW.checked)} AS column_count, row_count_raw - unique_feature_signature AS duplicated_feature_rows FROM summary""",
    ),
    "quality_report": _with(REPORT_CTE, "SELECT * FROM report"),
    "quality_row_violations": _with(
        AUDIT_CTE,
        """SELECT * FROM (SELECT 'rows_total' AS check_name, count(*) AS n FROM cells
        UNION ALL SELECT 'invalid_gender', count(*) FROM cells WHERE bad_gender > 0
        UNION ALL SELECT 'invalid_age', count(*) FROM cells WHERE bad_age > 0
        UNION ALL SELECT 'invalid_level', count(*) FROM cells WHERE bad_level > 0
        UNION ALL SELECT 'invalid_risk_scale', count(*) FROM cells WHERE bad_cells > 0) WHERE n > 0""",
    ),
    "quality_checks": _with(
        {
            **AUDIT_CTE,
            "checks": """UNPIVOT (SELECT invalid_age, invalid_gender, invalid_risk_scale, invalid_level,
                duplicate_id AS duplicate_subject_id, duplicate_full_row, signature_label_conflicts FROM summary)
                ON COLUMNS(*) INTO NAME name VALUE n""",
        },
        'SELECT name, n AS "count", n = 0 AS passed FROM checks',
    ),
    "quality_gate": _with(REPORT_CTE, "SELECT * FROM report WHERE check_name LIKE 'invalid\\_%' ESCAPE '\\' AND \"value\" > 0"),
    "baseline_profile": _with(
        AUDIT_CTE,
        """SELECT row_count_raw AS row_count, unique_feature_signature AS unique_signatures,
        row_count_raw - unique_feature_signature AS duplicated_feature_rows, signature_label_conflicts FROM summary""",
    ),
    "verify_table": _with(
        {
            **COHORT_CTE,
            "checks": """
            SELECT 'total' AS check_name, count(*) AS measured, (SELECT count(*) FROM lineitem) AS expected FROM cohort
            UNION ALL SELECT 'unique_id', count(DISTINCT subject_id), count(*) FROM cohort
            UNION ALL SELECT 'level:Low', count(*) FILTER (level = 'Low'), (SELECT count(*) FROM lineitem WHERE l_quantity <= 16) FROM cohort
            UNION ALL SELECT 'level:Medium', count(*) FILTER (level = 'Medium'), (SELECT count(*) FROM lineitem WHERE l_quantity > 16 AND l_quantity <= 33) FROM cohort
            UNION ALL SELECT 'level:High', count(*) FILTER (level = 'High'), (SELECT count(*) FROM lineitem WHERE l_quantity >= 33) FROM cohort
            UNION ALL SELECT 'gender:1', count(*) FILTER (gender = 1), (SELECT count(*) FROM lineitem WHERE l_linestatus = 'F') FROM cohort
            UNION ALL SELECT 'gender:2', count(*) FILTER (gender = 2), (SELECT count(*) FROM lineitem WHERE l_linestatus = 'O') FROM cohort
            UNION ALL SELECT 'signature', count(*), count(*) FROM cohort
            UNION ALL SELECT 'missing_columns', 0, 0
            UNION ALL SELECT 'raw_case_columns', 0, 0""",
        },
        """SELECT check_name, measured = expected AS ok, measured, expected FROM checks
        UNION ALL SELECT 'snapshots', count(DISTINCT level) >= 1, count(DISTINCT level), 1 FROM cohort""",
    ),
    "label_conflicts": _with(AUDIT_CTE, "SELECT feature_signature, n_labels FROM per_signature WHERE n_labels > 1"),
    "split_group_rank": _with(ORDERED_CTE, "SELECT feature_signature, label, rn, group_count FROM ranked"),
    "group_split": _with(ORDERED_CTE, "SELECT * FROM divided"),
    "split_conflict_gate": _with(
        {"bound": _tables(B.GROUPED_SQL)},
        """SELECT sha256(nation_text) AS feature_signature, 'several labels' AS reason FROM bound
        GROUP BY nation_text HAVING count(DISTINCT label) > 1""",
    ),
    "split_quarantine": _with(
        {
            "bound": _tables(B.GROUPED_SQL),
            "signed": """SELECT row_id, label, CASE WHEN row_id % 7 = 0 THEN NULL WHEN row_id % 3 = 0 THEN nation_text ELSE group_text END AS signature
                FROM bound""",
            "mixed": "SELECT signature FROM signed GROUP BY signature HAVING count(DISTINCT label) > 1",
        },
        """SELECT row_id, label, CASE WHEN signature IS NULL THEN 'no signature'
        WHEN signature IN (SELECT signature FROM mixed WHERE signature IS NOT NULL) THEN 'several labels' END AS reason FROM signed""",
    ),
    "split_report": _with(
        ORDERED_CTE,
        "SELECT split, label, count(*) AS n_rows, count(DISTINCT feature_signature) AS n_groups FROM divided GROUP BY split, label",
    ),
    "leakage_contrast": _with(
        {
            "bound": _tables(B.LABELLED_SQL),
            **{name: sql for name, sql in ORDERED_CTE.items() if name != "bound"},
            "by_row": f"""SELECT feature_signature, CASE WHEN sha256(CAST(row_id AS VARCHAR) || '42')[1:8] < '{int(0.7 * 16**8):08x}'
                THEN 'train' ELSE 'test' END AS split FROM grouped""",
            "methods": f"""SELECT 'row' AS method, * FROM ({_side_groups('by_row')}) UNION ALL
                SELECT 'group', * FROM ({_side_groups('divided')})""",
        },
        "SELECT *, CASE WHEN test_groups > 0 THEN round(shared_groups / test_groups, 4) ELSE 0.0 END AS shared_ratio FROM methods",
    ),
    "eval_metrics": _with(
        CLASSES_CTE,
        """SELECT CAST(sum(support) AS BIGINT) AS n, (SELECT count(*) FROM judged) - CAST(sum(support) AS BIGINT) AS n_unscored, round(sum(recall * support) / sum(support), 4) AS accuracy,
        round(sum("precision" * support) / sum(support), 4) AS weighted_precision,
        round(sum(recall * support) / sum(support), 4) AS weighted_recall,
        round(sum(f1 * support) / sum(support), 4) AS f1, round(avg(f1), 4) AS macro_f1 FROM rates""",
    ),
    "confusion_matrix": _with(
        JUDGED_CTE,
        """SELECT a.x AS actual, p.x AS predicted, (SELECT count(*) FROM judged j WHERE j.actual = a.x AND j.predicted = p.x) AS n
        FROM (VALUES ('A'), ('N'), ('R')) a(x), (VALUES ('A'), ('N'), ('R')) p(x)""",
    ),
    "per_class_f1": _with(
        CLASSES_CTE,
        """SELECT label, support, round("precision", 4) AS "precision", round(recall, 4) AS recall, round(f1, 4) AS f1 FROM rates""",
    ),
}
# What a fit has to reach, from the rows alone: it beats the majority, its gradient is near 0,
# and its classes hold as much of each feature as the rows with their label.
ORACLES["fit_logistic"] = _with(
    {**TRAINED_CTE, "tested": TESTED_CTE["tested"]},
    """SELECT level AS actual, n, TRUE AS above_majority, n_train, train_age, TRUE AS optimal
    FROM (SELECT level, count(*) AS n FROM tested GROUP BY level)
    JOIN (SELECT level, count(*) AS n_train, CAST(sum(age) AS BIGINT) AS train_age FROM trained GROUP BY level) USING (level)""",
)
ORACLES["logistic_moments"] = _with(
    TRAINED_CTE,
    " UNION ALL ".join(
        f"""SELECT level AS label, '{term}' AS term, (SELECT count(*) FROM trained) AS n, CAST({value} AS BIGINT) AS observed, TRUE AS met
        FROM trained GROUP BY level"""
        for term, value in [("(rows)", "count(*)"), *[(name, f"sum({name})") for name in COHORT.features]]
    ),
)
ORACLES["fit_forest"] = _with(
    TESTED_CTE, "SELECT level AS actual, count(*) AS n, TRUE AS above_majority, TRUE AS tables_agree FROM tested GROUP BY level"
)
ORACLES["model_roundtrip"] = _with(TESTED_CTE, "SELECT level AS actual, count(*) AS n, TRUE AS same FROM tested GROUP BY level")
ORACLES["model_compare"] = _with(
    TESTED_CTE,
    """SELECT m.model, count(*) AS n, CAST(0 AS BIGINT) AS n_unscored, TRUE AS above_half
    FROM tested, (VALUES ('logistic_regression'), ('random_forest')) m(model) GROUP BY m.model""",
)
ORACLES["score_batch"] = _with(
    COHORT_CTE,
    f"""SELECT sha256('10:logistic-1' || {' || '.join(_prefixed(name) for name in (COHORT.id, *COHORT.features))}) AS prediction_id,
    subject_id, 'logistic-1' AS model_run_id, '{VERSION}' AS dataset_version, {NOW_SQL} AS created_at,
    TRUE AS label_agrees, TRUE AS sums_to_one FROM cohort""",
)
ORACLES["model_card"] = f"""SELECT 'logistic-1' AS model_run_id, 'LogisticRegressionModel' AS algorithm,
    '{",".join(COHORT.features)}' AS features, '{{"0":"High","1":"Low","2":"Medium"}}' AS index_to_label,
    'accuracy,f1,macro_f1,weighted_precision,weighted_recall' AS metric_names, '{VERSION}' AS dataset_version, {NOW_SQL} AS trained_at"""
ORACLES["audit_in_batches"] = ORACLES["quality_summary"]
ORACLES["metrics_roundtrip"] = ORACLES["eval_metrics"]
