"""Named queries over the given tables, each with the SQL that checks it."""

from tidemark.plans import (  # noqa: F401
    aggregates,
    checks,
    eventtime,
    facts,
    joins,
    metrics,
    patterns,
    rows,
    state,
    storage,
    streams,
)
from tidemark.plans.registry import ENTRIES

__all__ = ["ENTRIES"]
