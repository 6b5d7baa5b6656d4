"""Registered queries over the driver tables, and their SQL counterparts."""

from __future__ import annotations

from . import evaluation, matching, reconciliation, reporting, scalars

_PARTS = (reconciliation, scalars, matching, evaluation, reporting)


def all_queries():
    out = {}
    for part in _PARTS:
        out.update(part.query.queries)
    return out


def all_sql():
    out = {}
    for part in _PARTS:
        out.update(part.query.sql)
    return out
