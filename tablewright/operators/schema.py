"""Schema reconciliation: bring any frame to a declared schema in one projection."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.types import logical_type


def resolve_names(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """Match names without case: the table's spelling, the request's order, unknown dropped."""
    known = {}
    for name in df.columns:
        known.setdefault(name.lower(), name)
    return [known[w.lower()] for w in wanted if w.lower() in known]


def select_variables(df: DataFrame, wanted: Iterable[str] | None) -> DataFrame:
    if wanted is None:
        return df
    return df.select(*[F.col(f"`{n}`") for n in resolve_names(df, wanted)])


def coerce_column(source: T.StructField, target: T.StructField, lenient: bool = False) -> Column:
    """Cast one column to its declared type.

    Strict casts raise on a bad value; lenient ones give null.
    """
    value = F.col(f"`{source.name}`")
    if source.dataType != target.dataType:
        value = (value.try_cast if lenient else value.cast)(target.dataType)
    return value.alias(target.name, metadata=target.metadata or {})


def coerce_types(df: DataFrame, declared: T.StructType, lenient: bool = False) -> DataFrame:
    """Cast the declared columns ``df`` has; keep its order and its other columns."""
    targets = {f.name.lower(): f for f in declared}
    return df.select(
        *[
            coerce_column(f, targets[f.name.lower()], lenient)
            if f.name.lower() in targets
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def fill_missing_columns(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Append each declared column ``df`` lacks as a typed null."""
    have = {n.lower() for n in df.columns}
    missing = [f for f in declared if f.name.lower() not in have]
    return df.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata or {}) for f in missing]
    )


def reorder_columns(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Declared columns in declared order; a missing one is an error."""
    have = {n.lower(): n for n in df.columns}
    absent = [f.name for f in declared if f.name.lower() not in have]
    if absent:
        raise ValueError(f"columns not in the data: {', '.join(absent)}")
    return df.select(*[F.col(f"`{have[f.name.lower()]}`").alias(f.name) for f in declared])


def conform(
    df: DataFrame, declared: T.StructType, lenient: bool = False, strict: bool = False
) -> DataFrame:
    """Cast, fill and reorder in a single projection; extra columns are dropped.

    ``strict`` is the read of a table whose storage already is its schema: nothing is
    filled or cast, and a missing column is an error.
    """
    if strict:
        return reorder_columns(df, declared)
    have = {f.name.lower(): f for f in df.schema}
    columns = []
    for target in declared:
        source = have.get(target.name.lower())
        if source is None:
            filler = F.lit(None).cast(target.dataType)
            columns.append(filler.alias(target.name, metadata=target.metadata or {}))
        else:
            columns.append(coerce_column(source, target, lenient))
    return df.select(*columns)


def union_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """Columns of all parts, first spelling and first position; clashing types become text."""
    merged: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema:
            seen = merged.get(f.name.lower())
            if seen is None:
                merged[f.name.lower()] = T.StructField(f.name, f.dataType, True, f.metadata)
            elif seen.dataType != f.dataType:
                merged[f.name.lower()] = T.StructField(
                    seen.name, _wider(seen.dataType, f.dataType), True, seen.metadata
                )
    return T.StructType(list(merged.values()))


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def merge_uploads(
    parts: list[DataFrame], declared: T.StructType | None = None, lenient: bool = False
) -> DataFrame:
    """One table from parts with inconsistent columns.

    Every part is cast to the declared type *before* the union, so that the union never
    picks a common type of its own.
    """
    if not parts:
        raise ValueError("nothing to merge")
    declared = declared or union_schema(p.schema for p in parts)
    return reduce(DataFrame.unionByName, [conform(p, declared, lenient) for p in parts])


def geography_variable(df: DataFrame, name: str | None = None) -> str:
    """The named geography column, or the first one in selected order."""
    if name:
        found = resolve_names(df, [name])
        if found:
            return found[0]
    else:
        for f in df.schema:
            if logical_type(f) == "geography":
                return f.name
    raise LookupError("unable to find a geography variable in the table")
