"""All registered queries."""

from tidemark.workload import feeds, live, numbers, storage, streams  # noqa: F401
from tidemark.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
