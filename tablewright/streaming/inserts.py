"""Row inserts as a stream: JSON text files in, parquet rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tablewright.operators.sinks import parse_rows
from tablewright.sources.uploads import UploadTable


def insert_rows_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    available_now: bool = True,
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Append the JSON rows of new text files below ``source`` to ``target``.

    The checkpoint makes each file count once over restarts. With ``available_now`` the
    query takes what is there, in bounded batches, and ends.
    """
    writer = _rows(spark, source, schema, max_files_per_trigger).format("parquet").option("path", target)
    return _start(writer, checkpoint, available_now)


def insert_uploads_stream(
    source: str,
    table: UploadTable,
    name: str,
    checkpoint: str,
    schema: T.StructType,
    available_now: bool = True,
    max_files_per_trigger: int = 1000,
    compact_every: int = 20,
) -> StreamingQuery:
    """The same into a table of uploads: each batch is one upload, ``<name>_<batch>``.

    A batch that a restart repeats finds its upload there and is left alone, so every row
    counts once. Every ``compact_every`` batches small uploads are merged, so that the
    table has a bounded number of folders for each ``SMALL_ROWS`` rows, however many batches.
    """

    def insert(batch: DataFrame, batch_id: int) -> None:
        table.upload(batch, f"{name}_{batch_id}", if_not_exists=True)
        if compact_every and batch_id % compact_every == compact_every - 1:
            table.compact()

    writer = _rows(table.spark, source, schema, max_files_per_trigger).foreachBatch(insert)
    return _start(writer, checkpoint, available_now)


def _rows(spark: SparkSession, source: str, schema: T.StructType, max_files: int) -> DataStreamWriter:
    text = spark.readStream.option("maxFilesPerTrigger", max_files).text(source)
    return parse_rows(text, schema).writeStream.outputMode("append")


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
