"""Names of all queries over the reference tables, and the SQL they are checked against."""

from __future__ import annotations

from . import cleaning, enrichment, identities, lookups, maintenance, relations, reports, views

MODULES = (reports, relations, cleaning, enrichment, maintenance, identities, views, lookups)
QUERIES = {name: query for module in MODULES for name, query in module.R.queries.items()}
ORACLE_SQL = {name: sql for module in MODULES for name, sql in module.R.sql.items()}


def flagship(spark, sf_dir):
    """The case overview: joins, one aggregation per child, status and due date."""
    return QUERIES["case_overview"](spark, sf_dir)
