"""All registered queries."""

from __future__ import annotations

from navloom.catalog import aggregates, duediligence, funds, joins, market, performance, portfolios, projections, sources, windows  # noqa: F401
from navloom.catalog.base import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
