"""All registered queries."""

from __future__ import annotations

from hubbub.plans import (  # noqa: F401
    queries_boosting,
    queries_fraud,
    queries_language,
    queries_recommend,
    queries_sinks,
    queries_stats,
    queries_streaming,
    queries_text,
    queries_vectors,
)
from hubbub.plans.registry import ORACLES, QUERIES, ROWS


def queries():
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)


def row_queries():
    return dict(ROWS)
