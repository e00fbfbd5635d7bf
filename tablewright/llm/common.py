"""What the operators of this subpackage share: input columns, Arrow batches, registration."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.session import tune

# Rows of one Arrow batch: a few hundred whole texts stay within some tens of MB.
BATCH_ROWS = 512

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLE: dict[str, str] = {}


def prepared(spark: SparkSession) -> SparkSession:
    """The library's settings, and Arrow batches small enough for whole texts."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def register(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def wrap(run: Run) -> Run:
        QUERIES[name] = lambda spark, sf_dir: run(prepared(spark), sf_dir)
        if sql:
            ORACLE[name] = sql
        return run

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone, so that no further column can clash or is read."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Map Arrow batches. ``make`` is called in each task and returns a function from
    the batch's columns (Python lists) to the columns of the result (in schema order,
    lists or NumPy arrays)."""
    target = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            columns = step(*(c.to_pylist() for c in batch.columns))
            arrays = [pa.array(c, f.type) for c, f in zip(columns, target, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)
