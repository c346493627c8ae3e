"""Query catalogue: importing the modules below fills the registry."""

from millrace.plans import actions, contamination, conversations, dedup, details, evaluation, quality, reports, runs, selection, streams, text, trajectory  # noqa: F401
from millrace.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
