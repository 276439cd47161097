"""All registered queries and their oracle SQL."""

from __future__ import annotations

from sitecast.plans.catalog import QUERIES as BATCH_QUERIES
from sitecast.plans.oracle import ORACLE
from sitecast.plans.temporal import ORACLE as TEMPORAL_ORACLE
from sitecast.plans.temporal import QUERIES as TEMPORAL_QUERIES
from sitecast.sources.history import HISTORY_QUERIES
from sitecast.streaming.eventtime import ORACLE as EVENT_ORACLE
from sitecast.streaming.eventtime import QUERIES as EVENT_QUERIES
from sitecast.streaming.jobs import STREAM_QUERIES


def all_queries() -> dict:
    return dict(sorted({**BATCH_QUERIES, **TEMPORAL_QUERIES, **STREAM_QUERIES, **EVENT_QUERIES, **HISTORY_QUERIES}.items()))


def all_oracle() -> dict:
    q = all_queries()
    return {k: v for k, v in {**ORACLE, **TEMPORAL_ORACLE, **EVENT_ORACLE}.items() if k in q}
