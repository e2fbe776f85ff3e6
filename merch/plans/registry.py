"""All registered queries."""

from __future__ import annotations

from merch.plans import allocation_queries, forecast_queries, grading_queries, history_queries, ingest_queries, listing_queries, moq_queries, streaming_queries
from merch.plans.query import Query

FAMILIES = [grading_queries, history_queries, forecast_queries, allocation_queries, moq_queries, listing_queries, ingest_queries, streaming_queries]


def all_queries() -> dict[str, Query]:
    merged: dict[str, Query] = {}
    for family in FAMILIES:
        for name, query in family.QUERIES.items():
            if name in merged:
                raise ValueError(f"query {name} is registered twice")
            merged[name] = query
    return merged
