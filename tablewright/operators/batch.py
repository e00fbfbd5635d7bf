"""Functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BatchFunction = Callable[[pa.RecordBatch], "pa.RecordBatch | pa.Table | None"]


def preprocess_batches(
    df: DataFrame, function: BatchFunction, schema: T.StructType | str | None = None
) -> DataFrame:
    """Run ``function`` on each record batch; ``None`` drops the batch.

    The function may change the schema, which then has to be declared. No shuffle: each
    scan task feeds its own batches through Arrow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            result = function(batch)
            if result is None:
                continue
            if isinstance(result, pa.Table):
                yield from result.to_batches()
            else:
                yield result

    return df.mapInArrow(run, schema or df.schema)


def file_chunks(
    files: DataFrame,
    chunk_bytes: int,
    start_byte: int = 0,
    end_byte: int | None = None,
    content: str = "content",
) -> DataFrame:
    """One row per byte chunk of each file: ``chunk_no, start_byte, end_byte, chunk``.

    ``end_byte`` is inclusive. Feed the result to :func:`preprocess_batches` to run a
    callback on the chunks.
    """
    if chunk_bytes < 1:
        raise ValueError("chunk_bytes must be positive")
    last = F.octet_length(content).cast("bigint") - 1
    if end_byte is not None:
        last = F.least(last, F.lit(end_byte).cast("bigint"))
    keep = [c for c in files.columns if c != content]
    first = F.lit(start_byte).cast("bigint")
    numbered = files.select(*keep, content, last.alias("_last")).where(F.col("_last") >= first)
    start = F.col("start_byte")
    end = F.least(start + chunk_bytes - 1, F.col("_last"))
    return (
        numbered.select(
            "*",
            F.explode(F.sequence(first, F.col("_last"), F.lit(chunk_bytes).cast("bigint"))).alias("start_byte"),
        )
        .select(
            *keep,
            F.expr(f"(start_byte - {start_byte}) div {chunk_bytes}").alias("chunk_no"),
            "start_byte",
            end.alias("end_byte"),
            F.substr(F.col(content), (start + 1).cast("int"), (end - start + 1).cast("int")).alias("chunk"),
        )
    )
