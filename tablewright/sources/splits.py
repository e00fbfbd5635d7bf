"""Splits of a parquet table: its row groups dealt out by size.

Footers are read once, in tasks. Every split is a list of row groups, so reading all splits
reads each row group once, and reading one reads nothing of the others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.operators.schema import select_variables
from tablewright.operators.windows import running
from tablewright.session import materialize, shared_dir
from tablewright.sources.files import open_filesystem
from tablewright.sources.reader import read_frame

BATCH_ROWS = 8192
PLAN = "file string, row_group int, rows bigint, bytes bigint"


class RowGroups(InputPartition):
    def __init__(self, file: str, row_group: int):
        self.file, self.row_group = file, row_group


class RowGroupReader(DataSourceReader):
    """A task for each row group of a split; only the asked columns are read."""

    def __init__(self, options: dict, schema: T.StructType):
        self.plan, self.split, self.schema = options["plan"], int(options["split"]), schema

    def partitions(self) -> list[RowGroups]:
        system, path = open_filesystem(self.plan)
        found = pq.read_table(path, filesystem=system, columns=["file", "row_group"], filters=[("split", "=", self.split)])
        return [RowGroups(r["file"], r["row_group"]) for r in found.to_pylist()] or [RowGroups("", 0)]

    def read(self, partition: RowGroups) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        target = to_arrow_schema(self.schema)
        system, path = open_filesystem(partition.file)
        with system.open_input_file(path) as f:
            file = pq.ParquetFile(f)
            there = {n.lower(): n for n in file.schema_arrow.names}
            names = [there.get(n.lower()) for n in target.names]
            for batch in file.iter_batches(BATCH_ROWS, row_groups=[partition.row_group], columns=[n for n in names if n]):
                columns = [
                    batch.column(n).cast(t.type) if n else pa.nulls(len(batch), t.type)
                    for n, t in zip(names, target, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=target)


class RowGroupSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "parquet_row_groups"

    def reader(self, schema: T.StructType) -> RowGroupReader:
        return RowGroupReader(self.options, schema)


@dataclass(frozen=True)
class Splits:
    """What :func:`plan_splits` made of a table."""

    spark: SparkSession
    path: str
    schema: T.StructType
    count: int

    def plan(self) -> DataFrame:
        """(split, file, row_group, rows, bytes)."""
        return self.spark.read.parquet(self.path)

    def read(self, split: int, variables: Iterable[str] | None = None, max_results: int | None = None) -> DataFrame:
        """One split; only the chosen columns are read from its row groups."""
        if not 0 <= split < self.count:
            raise LookupError(f"there are splits 0 to {self.count - 1}")
        chosen = select_variables(self.spark.createDataFrame([], self.schema), variables).schema
        self.spark.dataSource.register(RowGroupSource)
        reader = self.spark.read.format(RowGroupSource.name()).schema(chosen)
        return read_frame(reader.options(plan=self.path, split=str(split)).load(), None, max_results)


def plan_splits(spark: SparkSession, table: str | Splits, target_count: int) -> Splits:
    """Deal the row groups of the parquet files at a path into ``target_count`` splits of
    about equal bytes, in the order of files. Splits may be empty where a table has fewer
    row groups. Columns that a file does not have are null there; values in folder names
    are not read.
    """
    if isinstance(table, Splits):
        raise ValueError("cannot split a split")
    if target_count < 1:
        raise ValueError("target_count must be positive")
    whole = spark.read.parquet(table)
    files = [(unquote(f),) for f in whole.inputFiles()]

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, path = open_filesystem(name)
                meta = pq.read_metadata(path, filesystem=system)
                groups = [meta.row_group(k) for k in range(meta.num_row_groups)]
                sizes = [sum(g.column(c).total_compressed_size for c in range(g.num_columns)) for g in groups]
                columns = [[name] * len(groups), list(range(len(groups))), [g.num_rows for g in groups], sizes]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["file", "row_group", "rows", "bytes"])

    types = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
    tasks = max(1, min(len(files), 8 * spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame(files, "file string").repartition(tasks)
    groups = materialize(listed.mapInArrow(footers, PLAN).where("rows > 0"), "footers")
    total = groups.agg(F.sum("bytes")).first()[0] or 1
    upto = running(groups, [], ["file", "row_group"], {"_upto": ("sum", "bytes")})
    middle = F.col("_upto") - F.col("bytes") / 2
    split = F.least(F.floor(middle * target_count / total), F.lit(target_count - 1)).cast("int")
    path = shared_dir(spark, "splits")
    upto.select(split.alias("split"), "file", "row_group", "rows", "bytes").write.parquet(path)
    return Splits(spark, path, whole.schema, target_count)
