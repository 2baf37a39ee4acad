"""The operators run on the supplied star-schema tables, each query with an independent SQL statement."""

from __future__ import annotations


def _load():
    from . import q_checks, q_cohort, q_gates, q_network, q_reconcile, q_schedule, q_summaries  # noqa: F401
    from . import registry
    return registry


def all_queries():
    return _load().callables()


def all_sql():
    return dict(_load().SQL)
