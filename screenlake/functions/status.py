"""Outcome classes of status entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from screenlake import fixed_values as fv


def outcome_of(status: Column) -> Column:
    return (
        F.when(status == fv.FAILED, "ligands_removed")
        .when(status == fv.FAILED_DOCKING, "ligands_failed_docking")
        .when(status == fv.SUCCEEDED, "ligands_succeeded_docking")
        .otherwise("unknown_event")
    )


def is_failure(status: Column) -> Column:
    return status.contains("failed")


def is_success(status: Column) -> Column:
    return status.contains(fv.SUCCEEDED)
