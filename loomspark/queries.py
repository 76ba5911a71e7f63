"""Core queries by name, and their SQL."""

from __future__ import annotations

from loomspark.workloads import QUERIES, SQL, Query, etl, evaluation, mixing, relational  # noqa: F401


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
