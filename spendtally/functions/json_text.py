"""JSON held in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, no_match_to_null, trim_all


def response_match(c) -> Column:
    """Answer in a match response: an object with ``match``, a bare JSON string or plain text.

    Anything else is read as plain text, so a later membership test rejects it.
    """
    text = _col(c)
    parsed = F.try_parse_json(text)
    shape = F.schema_of_variant(parsed)
    has_match = F.coalesce(F.array_contains(F.json_object_keys(text), "match"), F.lit(False))
    answer = (
        F.when(shape.startswith("OBJECT") & has_match,
               F.coalesce(F.try_variant_get(parsed, "$.match", "string"), F.lit("")))
        .when(shape == "STRING", F.try_variant_get(parsed, "$", "string"))
        .otherwise(F.coalesce(text, F.lit("")))
    )
    return no_match_to_null(trim_all(answer))


def json_ids(c) -> Column:
    """JSON array text -> array of strings (mixed numbers and strings both read)."""
    return F.from_json(_col(c), "array<string>")
