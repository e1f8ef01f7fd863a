"""All registered queries."""

from touchline.plans import (  # noqa: F401
    date_queries,
    ingest_queries,
    page_queries,
    pair_queries,
    quality_queries,
    scalar_queries,
    source_queries,
    stat_queries,
    stream_queries,
)
from touchline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
