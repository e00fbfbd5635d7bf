"""Raw files as rows ``(name, content)``."""

from __future__ import annotations

import base64
import fnmatch
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.session import materialize

TASK_BYTES = 1 << 30
PIECE_BYTES = 1 << 22
PART_BYTES = 1 << 26


def open_filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it. Names in it are as they are,
    not percent-encoded, as in Spark's paths."""
    uri = re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]:", "s3:", uri))
    if m := re.match(r"([A-Za-z][A-Za-z0-9+.-]*)(://[^/]*)(/.*)?$", uri, re.DOTALL):
        # other systems take options behind a question mark
        uri = m[1] + m[2] + quote(m[3] or "", safe="/" if m[1] == "file" else "/?&=:")
    return fs.FileSystem.from_uri(uri)


def glob_patterns(glob: str) -> list[str]:
    """A glob with ``{a,b}`` as several without, as the standard library reads them."""
    m = re.match(r"(.*?)\{([^{}]*)\}(.*)$", glob, re.DOTALL)
    if m:
        return [p for part in m[2].split(",") for p in glob_patterns(m[1] + part + m[3])]
    return [glob.replace("[^", "[!")]


def list_files(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """All files below a directory, empty ones too: ``name`` (relative), ``size``,
    ``modified_at``. ``glob`` is matched against base names, with ``* ? [] {}``. Names
    beginning with a dot are not listed.

    Tasks list one level of directories after the other, so neither the driver nor a task
    holds more than a directory's own entries.
    """
    system, root = open_filesystem(directory)
    root = root.rstrip("/")
    patterns = glob_patterns(glob) if glob else None
    schema = "name string, is_dir boolean, size bigint, ms bigint"

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (below,) in zip(batch.column(0).to_pylist()):
                entries = system.get_file_info(fs.FileSelector(f"{root}/{below}" if below else root or "/"))
                rows = [
                    (f"{below}/{i.base_name}" if below else i.base_name, not i.is_file, i.size or 0, (i.mtime_ns or 0) // 1_000_000)
                    for i in entries
                    if not i.base_name.startswith(".")
                    and not (i.is_file and patterns and not any(fnmatch.fnmatchcase(i.base_name, p) for p in patterns))
                ]
                columns = list(zip(*rows)) or [[], [], [], []]
                kinds = (pa.string(), pa.bool_(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["name", "is_dir", "size", "ms"])

    level, parts = spark.createDataFrame([("",)], "name string"), []
    while True:
        found = materialize(level.mapInArrow(listed, schema), "listing")
        parts.append(found.where("not is_dir"))
        level = found.where("is_dir").select("name").repartition(max(spark.sparkContext.defaultParallelism, 1))
        if level.isEmpty():
            break
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select("name", "size", F.timestamp_millis("ms").cast("timestamp_ntz").alias("modified_at"))


def _open_each(files: DataFrame, directory: str, read: Callable, columns: str, size: str = "size") -> DataFrame:
    """Rows of ``files`` (with ``name``) with what ``read`` gives for the opened file and the
    row, in tasks of about TASK_BYTES by the column ``size``. A row may give several rows;
    they are made one by one, so that no more than one is in memory."""
    spark = files.sparkSession
    system, root = open_filesystem(directory)
    root, kept = root.rstrip("/"), files.columns
    volume = files.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] if size in kept else 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-volume // TASK_BYTES))
    schema = T.StructType([*files.schema.fields, *T._parse_datatype_string(columns).fields])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{root}/{row['name']}") as f:
                    for more in read(f, row):
                        values = [*(row[c] for c in kept), *more]
                        yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(values, target, strict=True)], schema=target)

    return files.repartition(tasks).mapInArrow(run, schema)


def stream_hashes(files: DataFrame, directory: str, start_byte: int = 0, name: str = "md5_hash") -> DataFrame:
    """Adds the ``md5_hash`` of all bytes from ``start_byte`` on to listed files; tasks read
    each file in pieces, of any size."""

    def read(f, row):
        md5 = hashlib.md5()
        f.seek(min(start_byte, f.size()))
        while piece := f.read(PIECE_BYTES):
            md5.update(piece)
        yield (base64.b64encode(md5.digest()).decode(),)

    return _open_each(files, directory, read, f"{name} string")


def part_hashes(files: DataFrame, directory: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row for each part of ``part_bytes`` of each listed file, with ``part``, its
    ``part_bytes`` and ``part_md5`` (hex). An empty file has one empty part. Parts are read
    apart, so a file of any size is as many tasks as it needs."""
    if part_bytes < 1:
        raise ValueError("part_bytes must be positive")
    last = F.greatest(F.ceil(F.col("size") / part_bytes).cast("bigint") - 1, F.lit(0).cast("bigint"))
    parts = files.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    parts = parts.withColumn("part_bytes", F.least(F.lit(part_bytes), F.col("size") - F.col("part") * part_bytes).cast("bigint"))

    def read(f, row):
        md5, left = hashlib.md5(), row["part_bytes"]
        f.seek(row["part"] * part_bytes)
        while left and (piece := f.read(min(left, PIECE_BYTES))):
            md5.update(piece)
            left -= len(piece)
        if left:
            raise IOError(f"{row['name']} is shorter than when it was listed")
        yield (md5.hexdigest(),)

    return _open_each(parts, directory, read, "part_md5 string", "part_bytes")


def tree_hashes(files: DataFrame, directory: str, part_bytes: int = PART_BYTES, name: str = "tree_md5") -> DataFrame:
    """Adds ``tree_md5`` to listed files: the md5 (hex) of the digests of their parts, one
    behind the other. It tells equal contents as ``md5_hash`` does, if the parts are as
    large, and a large file is hashed by many tasks; its list of parts is what one row holds."""
    parts = part_hashes(files, directory, part_bytes).groupBy(*files.columns)
    listed = F.sort_array(F.collect_list(F.struct("part", "part_md5")))
    return parts.agg(F.md5(F.array_join(F.transform(listed, lambda p: p["part_md5"]), "")).alias(name))


def stream_range(files: DataFrame, directory: str, start_byte: int = 0, end_byte: int | None = None, name: str = "content") -> DataFrame:
    """Adds bytes ``start_byte`` to ``end_byte`` (inclusive; the whole rest without it) of
    listed files; only these are read."""

    def read(f, row):
        f.seek(min(start_byte, f.size()))
        yield (f.read() if end_byte is None else f.read(max(end_byte - start_byte + 1, 0)),)

    return _open_each(files, directory, read, f"{name} binary")


def stream_chunks(files: DataFrame, directory: str, chunk_bytes: int, start_byte: int = 0, end_byte: int | None = None) -> DataFrame:
    """One row per byte chunk of each listed file: ``chunk_no, start_byte, end_byte, chunk``.
    ``end_byte`` is inclusive. Tasks hold one chunk at a time."""
    if chunk_bytes < 1:
        raise ValueError("chunk_bytes must be positive")

    def read(f, row):
        size = f.size()
        last = size - 1 if end_byte is None else min(size - 1, end_byte)
        for k, at in enumerate(range(start_byte, last + 1, chunk_bytes)):
            f.seek(at)
            piece = f.read(min(chunk_bytes, last + 1 - at))
            yield (k, at, at + len(piece) - 1, piece)

    return _open_each(files, directory, read, "chunk_no bigint, start_byte bigint, end_byte bigint, chunk binary")


def scan_files(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """Listed files with their whole ``content``. It has to fit a cell: use the streaming
    functions for files of any size, and :func:`list_files` if the content is not needed."""
    return stream_range(list_files(spark, directory, glob), directory)


def file_specs(spark: SparkSession, specs: Iterable[Mapping]) -> DataFrame:
    """Explicit files given as ``{"name", "data"}``; text data is taken as UTF-8."""
    rows = []
    for spec in specs:
        if "name" not in spec:
            raise ValueError("a file given by its data needs a name")
        data = spec["data"]
        rows.append((spec["name"], data.encode() if isinstance(data, str) else bytes(data)))
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("content", T.BinaryType())])
    return spark.createDataFrame(rows, schema).withColumn("size", F.octet_length("content").cast("bigint"))


def file_paths(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Explicit files given by path; each is named by its base name."""
    return spark.read.format("binaryFile").load(list(paths)).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "content", F.col("length").alias("size")
    )


def specs_from_rows(df: DataFrame, name: str, content: str) -> DataFrame:
    """File specifications that a query derives, one per row."""
    return df.select(
        F.col(name).alias("name"),
        F.col(content).cast("binary").alias("content"),
        F.octet_length(content).cast("bigint").alias("size"),
    )
