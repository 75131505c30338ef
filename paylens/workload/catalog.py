"""All registered queries with their SQL equivalents."""

from __future__ import annotations

from paylens.workload import file_queries, rule_queries  # noqa: F401  (they register their queries)
from paylens.workload.model_queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
