"""All registered queries."""

from __future__ import annotations

from millrace.plans import models, relational, stores, streams  # noqa: F401  (each registers its queries)
from millrace.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
