"""Spend flags and the contract status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import expired
from .text import _col

# --- fixed values -----------------------------------------------------------
AMBER_MIN_MONTHS = 3
STATUS_MONTHS_THRESHOLD = 6
# ----------------------------------------------------------------------------


def has_spend(spend) -> Column:
    return F.coalesce(_col(spend) > 0, F.lit(False))


def no_spend(spend) -> Column:
    return F.coalesce(_col(spend) == 0, F.lit(False))


def red_flag(is_expired, spend) -> Column:
    return _col(is_expired) & no_spend(spend)


def amber_flag(is_expired, months, spend, min_months: int = AMBER_MIN_MONTHS) -> Column:
    return ~_col(is_expired) & F.coalesce(_col(months) > min_months, F.lit(False)) & no_spend(spend)


def contract_status(spend, end, months, as_of, threshold: int = STATUS_MONTHS_THRESHOLD) -> Column:
    return (
        F.when(has_spend(spend), "green")
        .when(expired(end, as_of, inclusive=True), "red")
        .when(_col(months) > threshold, "yellow")
        .otherwise("green")
    )


def status_reason(spend, end, months, as_of, threshold: int = STATUS_MONTHS_THRESHOLD) -> Column:
    return (
        F.when(has_spend(spend), "spend reported")
        .when(expired(end, as_of, inclusive=True), "ended without spend")
        .when(_col(months) > threshold, "running without spend")
        .otherwise("under threshold")
    )
