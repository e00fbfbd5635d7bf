"""Aggregate expressions. All combine partially before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def n() -> Column:
    return F.count(F.lit(1))


def all_(x) -> Column:
    """True if no value is false; nulls are skipped."""
    return F.bool_and(x)


def any_(x) -> Column:
    return F.bool_or(x)


def sd(x) -> Column:
    return F.stddev_samp(x)


def var(x) -> Column:
    return F.var_samp(x)


def cor(x, y) -> Column:
    return F.corr(x, y)


def cov(x, y) -> Column:
    return F.covar_samp(x, y)


def n_distinct(x) -> Column:
    """Distinct non-null values."""
    return F.count_distinct(x)


def median(x, accuracy: int = 10_000) -> Column:
    """An element near the middle (rank error at most rows/accuracy), null on no rows.

    A mergeable sketch: a hot group never lands in one task as rows.
    """
    return F.percentile_approx(x, 0.5, accuracy)


def first_by(x, order) -> Column:
    return F.min_by(x, order)


def last_by(x, order) -> Column:
    return F.max_by(x, order)

