"""Response-time and reachability features on event and order logs, as Spark jobs."""

from __future__ import annotations

__version__ = "0.1.0"
