"""From processed requests to scored addresses and blacklist entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from skywarden.operators.metrics import GAP_LIMIT_MS, metric_vectors
from skywarden.operators.scoring import blacklist, score
from skywarden.operators.tag import critical
from skywarden.schema import Flow


def scored_vectors(requests: DataFrame, flows: Sequence[Flow], critical_pages: Sequence[str],
                   window: str | None = "5 minutes", threshold_ms: int = GAP_LIMIT_MS,
                   weight: str | None = None) -> DataFrame:
    """Metric vectors with the result of every flow."""
    vectors = metric_vectors(requests, critical(critical_pages), window, threshold_ms=threshold_ms, weight=weight)
    return score(vectors, flows)


def blacklisted(requests: DataFrame, flows: Sequence[Flow], critical_pages: Sequence[str],
                window: str | None = "5 minutes", threshold_ms: int = GAP_LIMIT_MS, **kwargs) -> DataFrame:
    """Blacklist entries, one per address."""
    return blacklist(scored_vectors(requests, flows, critical_pages, window, threshold_ms), **kwargs)
