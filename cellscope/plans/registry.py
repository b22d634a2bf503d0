"""Collects every registered query and oracle."""

from __future__ import annotations


def _load():
    from . import queries as q
    from . import q_census, q_extra, q_labels, q_ml, q_prep, q_stats  # noqa: F401  (register on import)
    return q


def queries():
    return dict(_load().QUERIES)


def oracle_sql():
    return dict(_load().ORACLES)
