"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.aggregate import n_distinct
from tablewright.operators.windows import join_back


def summarise(
    df: DataFrame,
    keys: str | Sequence[str],
    values: Mapping[str, Column],
    distinct: Mapping[str, str] | None = None,
    sketches: bool = False,
) -> DataFrame:
    """Aggregates per group, with exact distinct counts (name -> column) beside them.

    Spark groups by key *and* distinct column first, and would keep one state of every
    other aggregate for each such pair. Say ``sketches=True`` if sketches are among the
    values: these states cost far more than a second pass over the one counted column.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not sketches:
        counts = [n_distinct(column).alias(name) for name, column in (distinct or {}).items()]
        return df.groupBy(*keys).agg(*[v.alias(k) for k, v in values.items()], *counts)
    out = df.groupBy(*keys).agg(*[v.alias(k) for k, v in values.items()])
    for name, column in (distinct or {}).items():
        counts = df.groupBy(*keys).agg(n_distinct(column).alias(name))
        out = join_back(out, counts, keys)
    return out


def pivot_wider_found(df: DataFrame, keys: str | Sequence[str], names: str, value: Column, most: int = 1000) -> DataFrame:
    """One column for each value of ``names``, found by a distinct first, in order. More
    than ``most`` of them are an error: they would be columns."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    found = sorted(r[0] for r in df.select(names).where(F.col(names).isNotNull()).distinct().limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"{names} has more than {most} values")
    return df.groupBy(*keys).pivot(names, found).agg(value)
