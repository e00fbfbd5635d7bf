"""Sinks: disk-backed datasets, exports, output tables, checked writes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tablewright.operators.schema import conform
from tablewright.session import materialize, path_exists, remove_path
from tablewright.sources.files import open_filesystem
from tablewright.types import GEOGRAPHY_CRS

FORMATS = ("csv", "parquet", "json", "orc")
# Fixed value: parquet row-group target.
ROW_GROUP_BYTES = 128 * 1024 * 1024


def to_dataset(df: DataFrame) -> DataFrame:
    """A disk-backed copy in the shared folder that further queries read."""
    return materialize(df, "dataset")


def write_verified(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> int:
    """Write parquet and check that what was written is what went in.

    Rows are counted on the way (no second pass) and compared with the footers of the files
    of this write, which tasks read. An append writes aside and then moves its files in, so
    it reads no older file, other writers may append at the same time, and a failed write
    leaves nothing at ``path``.
    """
    spark = df.sparkSession
    seen = Observation()
    rows = F.count(F.lit(1)).alias("rows")
    appending = mode == "append"
    aside = f"{path.rstrip('/')}/_writing-{uuid.uuid4().hex}" if appending else path
    df.observe(seen, rows).write.mode("errorifexists" if appending else mode).options(**options).parquet(aside)
    files = written_files(spark, aside)
    found = files.agg(F.sum("rows")).first()[0] or 0
    expected = seen.get["rows"]
    if found != expected:
        if appending:
            remove_path(spark, aside)
        raise IOError(f"{path} got {found} rows instead of {expected}")
    if appending:
        # the writer's names have an id of the job in them, so none is there twice
        materialize(moved_files(files.select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("target")), path), "moved")
        remove_path(spark, aside)
    return expected


def written_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, rows) of the parquet files in a folder, from their footers."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).select("path")

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            counts = []
            for p in paths:
                system, place = open_filesystem(p)
                counts.append(pq.read_metadata(place, filesystem=system).num_rows)
            yield pa.RecordBatch.from_pydict({"path": paths, "rows": counts})

    return names.mapInArrow(footers, "path string, rows bigint")


def moved_files(files: DataFrame, path: str) -> DataFrame:
    """Move files (path, target) to ``target`` below ``path``, in tasks; a repeated move
    finds its file in place. Call an action once."""
    system, root = open_filesystem(path)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                source, target = open_filesystem(row["path"])[1], f"{root.rstrip('/')}/{row['target']}"
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                if system.get_file_info(source).is_file:
                    system.move(source, target)
            yield batch

    return files.mapInArrow(move, files.schema)


# --- exports -----------------------------------------------------------------


def escaped_name(name: str) -> str:
    """Lower case, with every run of other characters than letters, digits and _ as _."""
    return re.sub(r"\W+", "_", name).lower()


def _textual(df: DataFrame) -> DataFrame:
    """Types that text formats do not hold, as text."""
    times = [f.name for f in df.schema if isinstance(f.dataType, T.TimeType)]
    return df.withColumns({n: F.col(n).cast("string") for n in times}) if times else df


def export(
    df: DataFrame,
    path: str,
    format: str = "csv",
    overwrite: bool = False,
    delimiter: str = ",",
) -> str:
    """Write a copy of a table; an existing target is an error unless ``overwrite``."""
    if format not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}")
    if format == "csv":
        df = _textual(df)
    writer = df.write.format(format).mode("overwrite" if overwrite else "errorifexists")
    if format == "csv":
        writer = writer.options(
            header="true",
            sep=delimiter,
            escape='"',
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
            timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        )
    writer.save(path)
    return path


def export_manifest(spark: SparkSession, path: str, name: str, format: str) -> DataFrame:
    """The files that :func:`export` wrote: ``part, target, path, size``.

    One file is ``<name>.<format>``; several are ``<name>/<six-digit part>.<format>``,
    numbered from 0 in the order of the tasks that wrote them, without gaps.
    """
    base = escaped_name(name)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    # one row per file; the numbers need one order of them all
    order = Window.partitionBy(F.lit(0)).orderBy(F.regexp_extract("path", r"part-(\d+)-", 1).cast("int"), "path")
    parts = listing.select(
        (F.row_number().over(order) - 1).alias("part"),
        F.col("path"),
        F.col("length").alias("size"),
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).alias("_files"),
    )
    numbered = F.concat(F.lit(f"{base}/"), F.lpad(F.col("part").cast("string"), 6, "0"), F.lit(f".{format}"))
    target = F.when(F.col("_files") == 1, F.lit(f"{base}.{format}")).otherwise(numbered)
    return parts.select("part", target.alias("target"), "path", "size")


def export_files(df: DataFrame, path: str, name: str, format: str = "csv", delimiter: str = ",") -> DataFrame:
    """Export under the names of :func:`export_manifest` below ``path`` and return the
    manifest. Files are written aside and moved in tasks once all are whole; a repeated
    move finds its file in place."""
    spark = df.sparkSession
    aside = f"{path.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    export(df, aside, format, delimiter=delimiter)
    manifest = materialize(export_manifest(spark, aside, name, format), "export")
    if path_exists(spark, f"{path}/{escaped_name(name)}.{format}") or path_exists(spark, f"{path}/{escaped_name(name)}"):
        remove_path(spark, aside)
        raise FileExistsError(f"{name} is already exported below {path}")
    moved = materialize(moved_files(manifest, path), "export")
    remove_path(spark, aside)
    return moved.withColumn("path", F.concat(F.lit(path.rstrip("/") + "/"), "target"))


# --- output tables -----------------------------------------------------------


def output_table(
    df: DataFrame,
    name: str,
    path: str,
    geography_variables: Sequence[str] = (),
    append: bool = False,
) -> DataFrame:
    """Create or replace a catalog table at a path. ``append`` adds to the table, or to
    the rows at the path if the catalog does not know the name; it never removes rows."""
    for g in geography_variables:
        if g not in df.columns:
            raise LookupError(f"no column {g} for the geography")
        meta = {**(df.schema[g].metadata or {}), "logical": "geography", "crs": GEOGRAPHY_CRS}
        df = df.withMetadata(g, meta)
    spark = df.sparkSession
    if append and spark.catalog.tableExists(name):
        df.write.mode("append").saveAsTable(name)
    elif append and path_exists(spark, path):
        df.select(*spark.read.parquet(path).columns).write.mode("append").parquet(path)
        spark.catalog.createTable(name, path, source="parquet")
    else:
        df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return spark.table(name)


# --- layout ------------------------------------------------------------------


def write_layout(df: DataFrame, path: str) -> None:
    """Parquet with row groups of about 128 MB: the writer closes a group by the bytes it
    has in hand. Statistics stay on: without them no reader could skip a group."""
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


# --- rows --------------------------------------------------------------------


def parse_rows(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON text rows as typed rows; text that is no record of the schema raises."""
    parsed = F.from_json(F.col(column), _json_schema(schema), {"mode": "FAILFAST"})
    return conform(df.select(parsed.alias("_r")).select("_r.*"), schema)


def _json_schema(schema: T.StructType) -> T.StructType:
    """What JSON text is parsed as: times are text there."""
    text = T.StringType()
    return T.StructType(
        [T.StructField(f.name, text if isinstance(f.dataType, T.TimeType) else f.dataType) for f in schema]
    )


def insert_rows(rows, path: str, schema: T.StructType, spark=None) -> int:
    """Append rows to a table: a DataFrame of rows, of JSON text, or a JSON string."""
    if isinstance(rows, str):
        text = spark.createDataFrame([(rows,)], "value string")
        items = F.from_json("value", T.ArrayType(_json_schema(schema)), {"mode": "FAILFAST"})
        rows = conform(text.select(F.inline(items)), schema)
    elif isinstance(rows, DataFrame):
        if rows.columns == ["value"]:
            rows = parse_rows(rows, schema)
    else:
        raise ValueError("rows must be a DataFrame or a JSON string")
    return write_verified(rows, path, mode="append")
