"""All registered queries."""

from __future__ import annotations

from spark_curate.catalog import collecting, deduping, evaluating, exporting, filtering, reviewing

MODULES = (filtering, evaluating, deduping, collecting, reviewing, exporting)


def queries():
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql():
    return {name: text for m in MODULES for name, text in m.SQL.items()}
