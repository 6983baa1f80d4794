"""Driver queries: every operator on the given tables, with an independent SQL answer."""

from suite import arrays, paging, relational, silver, state, storage, windows  # noqa: F401
from suite.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
