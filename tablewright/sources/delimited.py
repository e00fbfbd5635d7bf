"""Delimited text, parquet and in-memory frames as upload sources."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.sources import quoted
from tablewright.sources.files import open_filesystem

CORRUPT = "_corrupt_record"
# Names of files that only a whole stream decompresses.
_COMPRESSED = re.compile(r"\.(gz|gzip|bz2|zst|zstd|lz4|snappy|deflate|xz)$", re.IGNORECASE)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    delimiter: str = ",",
    has_header_row: bool = True,
    quote_character: str = '"',
    escape_character: str = '"',
    null_markers: Sequence[str] = (),
    has_quoted_newlines: bool = False,
    allow_jagged_rows: bool = False,
    skip_bad_records: bool = False,
    _headers: bool = True,
) -> DataFrame:
    """Read delimited files with the upload's dialect.

    Columns are read as text, null markers become null, then values are cast. A record
    with too few fields is bad unless ``allow_jagged_rows``; one with too many, or with a
    value that does not cast, is always bad. Bad records raise, or are dropped with
    ``skip_bad_records``. Without ``schema`` the columns stay text, named from the header.

    With a header row and a ``schema``, files are read by their own headers if these are the
    schema's names in another order; by position if the names are others. A header that
    has some of the names at other places raises.

    Files with quoted newlines are read by ranges, as others; only compressed ones are one
    task each. Their lines end with a line feed, after a carriage return or not.
    """
    quotes = quoted.Quotes(delimiter, quote_character, escape_character)
    if schema is not None and has_header_row and _headers:
        others = _reordered(spark, path, schema, quotes)
        if others is not None:
            dialect = dict(
                delimiter=delimiter,
                quote_character=quote_character,
                escape_character=escape_character,
                null_markers=null_markers,
                has_quoted_newlines=has_quoted_newlines,
                allow_jagged_rows=allow_jagged_rows,
                skip_bad_records=skip_bad_records,
                _headers=False,
            )
            parts = [read_delimited(spark, files, order, **dialect).select(*[f"`{n}`" for n in schema.names]) for order, files in others]
            return reduce(DataFrame.unionAll, parts)
    options = {
        "sep": delimiter,
        "header": str(has_header_row).lower(),
        "quote": quote_character,
        "escape": escape_character,
        "multiLine": str(has_quoted_newlines).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "enforceSchema": "true",
        "columnPruning": "false",
        # nothing between delimiters is null, quoted nothing is empty text
        "nullValue": "\x00",
        "emptyValue": "",
    }
    if schema is None:
        schema = spark.read.options(**{**options, "inferSchema": "false"}).csv(path).schema
    text = T.StructType(
        [T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(CORRUPT, T.StringType())]
    )
    if has_quoted_newlines and quote_character and not _compressed(spark, path):
        found = quoted.ranges(spark, path, quotes, RANGE_BYTES)
        lines = quoted.records(found, quotes, has_header_row)
        options = {k: v for k, v in options.items() if k not in ("header", "multiLine", "enforceSchema")}
        raw = lines.select(F.from_csv("value", text.toDDL(), options).alias("_r")).select("_r.*")
    else:
        raw = spark.read.schema(text).options(**options).csv(path)

    def clean(name: str) -> Column:
        value = F.col(f"`{name}`")
        return F.when(~value.isin(*null_markers), value) if null_markers else value

    # the reader marks records whose number of fields is off
    n, first = len(schema), F.col(f"`{schema[0].name}`")
    fields = _field_count(F.col(CORRUPT), delimiter, quote_character, escape_character)
    uneven = F.col(CORRUPT).isNotNull() & (fields > n if allow_jagged_rows else F.lit(True))
    # always true, but keeps a data column in the scan, which the reader asks for
    uneven = uneven & (F.coalesce(F.length(first), F.lit(0)) >= 0)
    typed = [clean(f.name).try_cast(f.dataType) for f in schema]
    misfit = [
        clean(f.name).isNotNull() & value.isNull()
        for f, value in zip(schema, typed)
        if not isinstance(f.dataType, T.StringType)
    ]
    bad = reduce(Column.__or__, misfit, uneven)
    if skip_bad_records:
        kept = raw.where(~bad)
    else:
        # a filter, because a column could be pruned away
        shown = F.coalesce(F.substring(CORRUPT, 1, 200), F.concat_ws(delimiter, *[F.col(f"`{f.name}`") for f in schema]))
        alarm = F.raise_error(F.concat(F.lit("bad record: "), shown)).cast("boolean")
        kept = raw.where(F.when(bad, alarm).otherwise(F.lit(True)))
    return kept.select(
        *[value.alias(f.name, metadata=f.metadata or {}) for f, value in zip(schema, typed)]
    )


RANGE_BYTES = quoted.RANGE_BYTES


def _compressed(spark: SparkSession, path: str | list[str]) -> bool:
    return any(_COMPRESSED.search(f) for f in spark.read.format("binaryFile").load(path).inputFiles())


def _reordered(
    spark: SparkSession, path: str | list[str], schema: T.StructType, quotes: quoted.Quotes
) -> list[tuple[T.StructType, list[str]]] | None:
    """The files by the order of their headers, each with the schema in that order; None if
    every header has the schema's order, or other names. Tasks read the first record of each
    file; the driver gets the different headers, and the file names that Spark lists."""
    files = spark.read.format("text").load(path).inputFiles()
    if not files:
        return None

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = []
            for uri in batch.column(0).to_pylist():
                system, name = open_filesystem(unquote(uri) if "://" in uri or uri.startswith("file:") else uri)
                compression = "detect" if _COMPRESSED.search(name) else None
                with system.open_input_stream(name, compression=compression) as f:
                    lines.append(quoted.first_record(f, quotes))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string())], ["file", "head"])

    tasks = min(len(files), spark.sparkContext.defaultParallelism)
    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(tasks)
    found = listed.mapInArrow(heads, "file string, head string").groupBy("head").agg(F.collect_list("file").alias("files")).collect()
    fields, out, moved = {f.name.lower(): f for f in schema}, [], False
    places = {n: i for i, n in enumerate(fields)}
    for r in found:
        rows = csv.reader(io.StringIO(r["head"], newline=""), delimiter=quotes.delimiter, quotechar=quotes.quote or None)
        names = [n.strip().lower() for n in next(rows, [])]
        same = sorted(names) == sorted(fields)
        elsewhere = [n for i, n in enumerate(names) if places.get(n, i) != i]
        if elsewhere and not same:
            raise ValueError(f"the header of {r['files'][0]} has {', '.join(elsewhere[:5])} at other places than the schema, and other names besides")
        moved = moved or (same and names != list(fields))
        out.append((T.StructType([fields[n] for n in names]) if same else schema, r["files"]))
    return out if moved else None


def _field_count(record: Column, delimiter: str, quote: str, escape: str) -> Column:
    """Fields of a raw record: delimiters outside quotes, plus one."""
    if quote:
        q, e = re.escape(quote), re.escape(escape or quote)
        record = F.regexp_replace(record, f"{q}(?:{e}.|[^{q}])*{q}", "")
    return F.size(F.split(record, re.escape(delimiter)))


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A parquet upload keeps the schema of its files."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def from_frame(spark: SparkSession, frame, schema: T.StructType | None = None) -> DataFrame:
    """A pandas frame, an Arrow table, or rows; a DataFrame passes through."""
    if isinstance(frame, DataFrame):
        return frame
    return spark.createDataFrame(frame, schema)
