"""Supplier keys and the supplier-buyer pair key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, na_to_null, trim_all

# --- fixed values -----------------------------------------------------------
MISSING_KEY_TEXT = "<NA>"
PAIR_SEPARATOR = "+"
# ----------------------------------------------------------------------------


def nullable_key(c) -> Column:
    """Text or float key -> bigint; null tokens -> null; 1.5 raises.

    Whole-number text takes an exact path (a double would lose digits past
    2**53); only text such as ``3.0`` goes through double.
    """
    text = trim_all(na_to_null(_col(c).cast("string")))
    number = text.cast("double")
    return (
        F.when(text.isNull(), F.lit(None).cast("bigint"))
        .when(text.rlike(r"^[+-]?[0-9]+$"), text.cast("bigint"))
        .when(number == F.floor(number), number.cast("bigint"))
        .otherwise(F.raise_error(F.concat(F.lit("not a whole-number key: "), text)).cast("bigint"))
    )


def pair_id(key, name) -> Column:
    """``key+lower(name)``; a missing key reads ``<NA>``, a missing name is null."""
    return F.concat(
        F.coalesce(_col(key).cast("string"), F.lit(MISSING_KEY_TEXT)),
        F.lit(PAIR_SEPARATOR), F.lower(_col(name)))
