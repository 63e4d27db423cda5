"""Cohort analytics as plain Spark DataFrame and Spark ML operators."""

from cohortloom.presets import PATIENT_RENAMES, PATIENTS
from cohortloom.schema import CohortSchema

__all__ = ["CohortSchema", "PATIENTS", "PATIENT_RENAMES"]
