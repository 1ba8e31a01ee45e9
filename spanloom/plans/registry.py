"""All registered queries of the core."""

from __future__ import annotations

from spanloom.plans import figure_queries, pipeline_queries, quote_queries, record_queries, run_queries, skew_queries, span_queries, work_queries

_MODULES = [skew_queries, span_queries, work_queries, quote_queries, record_queries, figure_queries, pipeline_queries, run_queries]


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: s for m in _MODULES for name, s in m.SQL.items()}
