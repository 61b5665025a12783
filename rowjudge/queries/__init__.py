"""All registered queries."""

from rowjudge.queries import judging, requests, runs, trained  # noqa: F401
from rowjudge.queries.registry import QUERIES

__all__ = ["QUERIES"]
