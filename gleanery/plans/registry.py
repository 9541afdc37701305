"""All queries over the test tables, by name, with their SQL twins."""

from __future__ import annotations

from . import base, files, finding, landing, rollups, rows, streams, tables  # noqa: F401

Query = base.Callable


def queries() -> dict[str, Query]:
    return base.QUERIES


def oracle_sql() -> dict[str, str]:
    return base.ORACLE
