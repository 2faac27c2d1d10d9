"""All queries of the core and their SQL."""

from __future__ import annotations

from rigweave.plans import alignment, data_problems, datasets, edges, exports, motion, quality, reports

MODULES = (alignment, motion, quality, datasets, reports, edges, exports, data_problems)


def queries() -> dict:
    return {name: f for module in MODULES for name, f in module.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.oracle_sql().items()}
