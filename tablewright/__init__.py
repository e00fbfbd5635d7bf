"""Versioned research tables on Spark: reads, queries, ingestion, file indexes, jobs."""

from tablewright.session import build_session, tune

__all__ = ["build_session", "tune"]
