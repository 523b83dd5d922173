"""All registered catalogue queries, each with its SQL."""

from __future__ import annotations

from granary.plans import clustering, inventory, rulebook, titles, views  # noqa: F401  (they register)
from granary.plans.registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
