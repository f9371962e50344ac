"""Every operator as a named query over the driver's tables, with its oracle."""

from respfeat.queries import joins, orders, scans, trailing  # noqa: F401
from respfeat.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
