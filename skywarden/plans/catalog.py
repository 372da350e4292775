"""All registered queries."""

from __future__ import annotations

from skywarden.plans import catalog_metrics, catalog_records, catalog_reports, catalog_streams  # noqa: F401
from skywarden.plans.registry import QUERIES

__all__ = ["QUERIES"]
