"""Cohorts over the supplied tables, as SQL that Spark and DuckDB both read.

Table names stand in braces: Spark fills them with frames, the oracle with the
bare names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.schema import CohortSchema

_COMMON = dict(
    id="subject_id",
    label="level",
    labels=("Low", "Medium", "High"),
    number="age",
    category="gender",
    codes={1: "male", 2: "female"},
)

COHORT = CohortSchema(
    **_COMMON,
    ordinals=("ind_part", "ind_supp", "ind_price", "ind_disc", "ind_tax", "ind_qty", "ind_line"),
    chart=("ind_qty", "ind_price"),
)
RAW = CohortSchema(**_COMMON, ordinals=("ind_part", "ind_qty", "ind_line"), chart=("ind_qty",))

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
QUALITIES = (0, 1)
FLAGS = ("A", "N", "R")

COHORT_SQL = """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS subject_id,
       CAST(l_quantity AS INT) AS age,
       CASE l_linestatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS gender,
       CAST(1 + l_partkey % 9 AS INT) AS ind_part,
       CAST(1 + l_suppkey % 9 AS INT) AS ind_supp,
       CAST(LEAST(9, 1 + FLOOR(l_extendedprice / 10000)) AS INT) AS ind_price,
       CAST(1 + ROUND(l_discount * 100) % 9 AS INT) AS ind_disc,
       CAST(1 + ROUND(l_tax * 100) AS INT) AS ind_tax,
       CAST(LEAST(9, 1 + FLOOR(l_quantity / 6)) AS INT) AS ind_qty,
       l_linenumber AS ind_line,
       CASE WHEN l_quantity <= 16 THEN 'Low' WHEN l_quantity <= 33 THEN 'Medium' ELSE 'High' END AS level
FROM {lineitem}
"""

# The cohort with labels that no linear model meets: a part of the signal is a remainder
# of several features. Rows with equal features have equal labels, so a split finds no conflict.
MODEL_SQL = f"""
SELECT subject_id, {", ".join(COHORT.features)},
       CASE WHEN signal <= 25 THEN 'Low' WHEN signal <= 45 THEN 'Medium' ELSE 'High' END AS level
FROM (SELECT c.*, age + 3 * ((7 * ind_part + 5 * ind_supp + 3 * ind_line + ind_tax * ind_disc) % 9) AS signal
      FROM ({COHORT_SQL}) c) s
"""

# Every column as text, with deterministic damage.
RAW_SQL = """
SELECT CASE WHEN l_orderkey % 91 <> 0 THEN CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)
         || CASE WHEN l_partkey % 5 = 0 THEN '  ' ELSE '' END END AS subject_id,
       CASE WHEN l_partkey % 97 = 0 THEN 'abc' WHEN l_partkey % 71 = 0 THEN 'NaN' WHEN l_partkey % 67 = 0 THEN '7d'
            WHEN l_partkey % 101 = 0 THEN '0x1p3' WHEN l_partkey % 103 = 0 THEN '-Infinity' WHEN l_partkey % 107 = 0 THEN '1_0'
            WHEN l_partkey % 109 = 0 THEN chr(9) || CAST(CAST(l_quantity AS INT) AS STRING) || chr(9) WHEN l_partkey % 89 = 0 THEN ''
            WHEN l_partkey % 83 = 0 THEN '130' WHEN l_partkey % 73 = 0 THEN NULL
            WHEN l_partkey % 79 = 0 THEN CAST(CAST(l_quantity AS INT) AS STRING) || '.5'
            ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS age,
       CASE WHEN l_suppkey % 41 = 0 THEN '3' WHEN l_suppkey % 31 = 0 THEN NULL WHEN l_suppkey % 37 = 0 THEN ''
            WHEN l_linestatus = 'F' THEN '1' ELSE '2' END AS gender,
       CASE WHEN l_partkey % 61 = 0 THEN '12' WHEN l_partkey % 59 = 0 THEN ' '
            WHEN l_partkey % 53 = 0 THEN '6.7' ELSE CAST(1 + l_partkey % 9 AS STRING) END AS ind_part,
       CAST(CAST(LEAST(9, 1 + FLOOR(l_quantity / 6)) AS INT) AS STRING) AS ind_qty,
       CASE WHEN l_linenumber = 7 THEN '0' ELSE CAST(l_linenumber AS STRING) END AS ind_line,
       CASE WHEN l_suppkey % 43 = 0 THEN 'Severe' WHEN l_suppkey % 47 = 0 THEN NULL
            WHEN l_quantity <= 16 THEN CASE WHEN l_linenumber = 1 THEN ' LOW ' ELSE 'Low' END
            WHEN l_quantity <= 33 THEN 'medium' ELSE 'High' END AS level
FROM {lineitem}
"""

# Rows that repeat the feature text of their customer: one group per customer.
GROUPED_SQL = """
SELECT o_orderkey AS row_id,
       CAST(c_custkey AS STRING) || '|' || CAST(c_nationkey AS STRING) || '|' || c_mktsegment AS group_text,
       CAST(c_nationkey AS STRING) AS nation_text,
       c_mktsegment AS label
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

LABELLED_SQL = """
SELECT d.doc_id AS row_id, d.text AS group_text, l.quality AS label
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id
"""

HISTORY_SQL = """
SELECT CAST(event_id AS STRING) AS prediction_id, CAST(user_id AS STRING) AS subject_id,
       event_type AS predicted_label, ts AS created_at
FROM {events}
"""

JUDGED_SQL = """
SELECT l_returnflag AS actual,
       CASE l_linestatus WHEN 'F' THEN 'A' ELSE l_returnflag END AS predicted
FROM {lineitem}
"""

# A row of the store and a part of the batch have no id.
STORE_SQL = """
SELECT CASE WHEN s_suppkey <> 3 THEN s_suppkey END AS id, s_acctbal AS amount, s_name AS note, CAST('2024-01-05 00:00:00' AS TIMESTAMP_NTZ) AS updated_at,
       CAST('2024-01-01 00:00:00' AS TIMESTAMP_NTZ) AS created_at
FROM {supplier}
"""

BATCH_SQL = """
SELECT CASE WHEN event_id % 11 <> 0 THEN user_id END AS id, value AS amount, event_type AS note, ts AS updated_at
FROM {events}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    names = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, COHORT_SQL)


def modelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, MODEL_SQL)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, RAW_SQL)


def grouped(spark: SparkSession, sf_dir: str, text: str = "group_text") -> DataFrame:
    return bind(spark, sf_dir, GROUPED_SQL).select(
        "row_id", F.sha2(text, 256).alias("feature_signature"), "label"
    )


def conflicting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `grouped`, but a third of the rows share their nation's signature and a seventh have none."""
    text = F.when(F.col("row_id") % 3 == 0, F.col("nation_text")).otherwise(F.col("group_text"))
    signature = F.when(F.col("row_id") % 7 != 0, F.sha2(text, 256))
    return bind(spark, sf_dir, GROUPED_SQL).select("row_id", signature.alias("feature_signature"), "label")


def skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `grouped`, but one signature holds a third of the rows and a seventh have none."""
    text = F.when(F.col("row_id") % 3 == 0, F.lit("everyone")).otherwise(F.col("group_text"))
    signature = F.when(F.col("row_id") % 7 != 0, F.sha2(text, 256))
    return bind(spark, sf_dir, GROUPED_SQL).select("row_id", signature.alias("feature_signature"), "label")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, LABELLED_SQL).select(
        "row_id", F.sha2("group_text", 256).alias("feature_signature"), "label"
    )


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, HISTORY_SQL)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, JUDGED_SQL)
