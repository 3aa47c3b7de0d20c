"""All registered queries."""

from agoralens.plans import (  # noqa: F401
    classify_queries,
    conclude_queries,
    epoch_queries,
    match_queries,
    profile_queries,
    stream_queries,
)
from agoralens.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
