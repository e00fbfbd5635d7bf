"""Typed table reads: column choice, row cap, geography, splits, samples."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.batch import BatchFunction, preprocess_batches
from tablewright.operators.schema import conform, geography_variable, select_variables

STREAM_COLUMN = "stream_id"


def read_table(
    spark: SparkSession,
    path: str,
    variables: Iterable[str] | None = None,
    max_results: int | None = None,
    declared: T.StructType | None = None,
    batch_preprocessor: BatchFunction | None = None,
    batch_schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read a parquet table; only the chosen columns reach the scan.

    ``declared`` is the schema to coerce to. ``max_results`` promises no order.
    """
    return read_frame(
        spark.read.parquet(path), variables, max_results, declared, batch_preprocessor, batch_schema
    )


def read_frame(
    df: DataFrame,
    variables: Iterable[str] | None = None,
    max_results: int | None = None,
    declared: T.StructType | None = None,
    batch_preprocessor: BatchFunction | None = None,
    batch_schema: T.StructType | str | None = None,
) -> DataFrame:
    """The same read for any DataFrame: a query, one upload, one read stream."""
    if declared is not None:
        df = conform(df, declared)
    df = select_variables(df, variables)
    if max_results is not None:
        df = df.limit(max_results)
    if batch_preprocessor is not None:
        df = preprocess_batches(df, batch_preprocessor, batch_schema)
    return df


def read_geography(
    df: DataFrame, variables: Iterable[str] | None = None, geography: str | None = None
) -> tuple[DataFrame, str]:
    """The read, and which of its columns holds the geography (WKT text, CRS in metadata)."""
    df = select_variables(df, variables)
    return df, geography_variable(df, geography)


def empty_table(spark: SparkSession, declared: T.StructType) -> DataFrame:
    return spark.createDataFrame([], declared)


# --- splits ------------------------------------------------------------------


def key_bucket(keys: Iterable[str], buckets: int) -> Column:
    """Stable bucket of a row from the md5 of its key columns, the same on every engine."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def read_streams(
    df: DataFrame, target_count: int, keys: Iterable[str], variables: Iterable[str] | None = None
) -> DataFrame:
    """Tag each row with the split it belongs to; the splits together are the table.

    A split is a filter on the tag, so reading one is a scan of many tasks and a key with
    many rows costs nothing extra.
    """
    if STREAM_COLUMN in df.columns:
        raise ValueError("cannot split a read stream")
    if target_count < 1:
        raise ValueError("target_count must be positive")
    tagged = df.withColumn(STREAM_COLUMN, key_bucket(keys, target_count))
    if variables is None:
        return tagged
    return select_variables(tagged, [*variables, STREAM_COLUMN])


def read_stream(
    streams: DataFrame,
    stream: int,
    variables: Iterable[str] | None = None,
    max_results: int | None = None,
) -> DataFrame:
    """One split, without the tag; the row cap holds here too."""
    return read_frame(
        streams.where(F.col(STREAM_COLUMN) == stream).drop(STREAM_COLUMN), variables, max_results
    )


def sample_rows(df: DataFrame, keys: Iterable[str], percent: float) -> DataFrame:
    """Repeatable sample: the same keys fall in it in every table and version."""
    return df.where(key_bucket(keys, 10_000) < int(round(percent * 100)))
