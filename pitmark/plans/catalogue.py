"""All registered queries of the library."""

from __future__ import annotations

from pitmark.plans import evaluation_queries, event_queries, market_queries, rank_queries, row_quality_queries, rule_queries, stream_queries, temporal_queries, whole_queries  # noqa: F401
from pitmark.plans.registry import BODIES, QUERIES  # noqa: F401
from pitmark.plans.views import with_views

ORACLES = {name: with_views(body) for name, body in BODIES.items()}
