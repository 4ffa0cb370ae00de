"""Every operator as a query over the benchmark tables, with the SQL that must give the same rows."""

from __future__ import annotations

from alluvia.queries import (  # noqa: F401  (imported for their registrations)
    changes, events, history, lake, maintenance, nested, orders, static, streams,
)
from alluvia.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
