"""The eight logical column types and their Spark storage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Logical type -> Spark type. Anything unknown is text.
SPARK_TYPES: dict[str, T.DataType] = {
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "dateTime": T.TimestampNTZType(),
    "time": T.TimeType(6),
    "geography": T.StringType(),
    "string": T.StringType(),
}
GEOGRAPHY_CRS = 4326


def spark_type(logical: str | None) -> T.DataType:
    return SPARK_TYPES.get(logical or "string", T.StringType())


def field(
    name: str,
    logical: str,
    label: str | None = None,
    description: str | None = None,
    value_labels: dict | None = None,
) -> T.StructField:
    """A column declaration; logical type and labels travel as field metadata."""
    metadata: dict = {"logical": logical}
    if logical == "geography":
        metadata["crs"] = GEOGRAPHY_CRS
    if label is not None:
        metadata["label"] = label
    if description is not None:
        metadata["description"] = description
    if value_labels:
        metadata["value_labels"] = {str(k): v for k, v in value_labels.items()}
    return T.StructField(name, spark_type(logical), True, metadata)


def schema(columns: dict[str, str] | Iterable[tuple[str, str]]) -> T.StructType:
    pairs = columns.items() if isinstance(columns, dict) else columns
    return T.StructType([field(name, logical) for name, logical in pairs])


def logical_type(f: T.StructField) -> str:
    """Declared logical type, else the one the storage type implies."""
    declared = (f.metadata or {}).get("logical")
    if declared:
        return declared
    dt = f.dataType
    if isinstance(dt, T.IntegralType):
        return "integer"
    if isinstance(dt, T.FractionalType):
        return "float"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "dateTime"
    if isinstance(dt, T.TimeType):
        return "time"
    return "string"
