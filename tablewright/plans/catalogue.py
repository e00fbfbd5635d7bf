"""All registered queries."""

from tablewright.plans import indexes, jobs, reads, relational, scalars  # noqa: F401
from tablewright.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
