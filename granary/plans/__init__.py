"""Registered queries with their SQL, family by family."""

from . import consolidate, enrichment, ingest, matching, normalize, quality, registry, relational

FAMILIES = (relational, normalize, consolidate, matching, enrichment, quality, ingest)


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict:
    return dict(registry.SQL)
