"""Every query of the variant engine with its DuckDB counterpart, by name."""

from __future__ import annotations

from . import queries_analysis, queries_functions, queries_merge, queries_scan  # noqa: F401  they register their queries
from .registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
