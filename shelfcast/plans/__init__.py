"""The registered queries and the SQL each is checked against."""

from __future__ import annotations

from shelfcast.plans import (  # noqa: F401  (importing registers the queries)
    columns,
    distributions,
    features,
    filters,
    forecasts,
    images,
    models,
    reading,
    samples,
    totals,
)
from shelfcast.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
