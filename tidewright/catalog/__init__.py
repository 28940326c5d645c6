"""Every operator as a named query over the benchmark tables, with its oracle SQL."""

from __future__ import annotations

from tidewright.catalog import basics, entities, report_queries, stars, stored, writes
from tidewright.catalog.registry import ORACLES, QUERIES, Query

FLAGSHIP = "flagship_margin_by_brand"
MODULES = (basics, writes, entities, stars, report_queries, stored)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
