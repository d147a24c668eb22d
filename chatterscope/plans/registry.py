"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from chatterscope.plans import (
    activity_queries,
    filter_queries,
    graph_queries,
    ngram_queries,
    page_queries,
    search_queries,
    source_queries,
    table_queries,
    trend_queries,
)

MODULES = (
    source_queries,
    table_queries,
    filter_queries,
    ngram_queries,
    activity_queries,
    graph_queries,
    trend_queries,
    page_queries,
    search_queries,
)


def queries():
    return {name: q for module in MODULES for name, q in module.CATALOG.queries.items()}


def oracle_sql():
    return {name: sql for module in MODULES for name, sql in module.CATALOG.sql.items()}
