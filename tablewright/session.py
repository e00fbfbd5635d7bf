"""Session settings, the shared work folder, and materialised intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Semantics every operator relies on; all are runtime SQL settings.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot join keys even when that costs another shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Cluster sizing for sessions we build ourselves: start wide, let AQE coalesce.
CLUSTER = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(app: str = "tablewright", cluster: bool = True, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SEMANTICS, **(CLUSTER if cluster else {}), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to a session somebody else made."""
    for key, value in SEMANTICS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local-mode session without a setting gets a folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    context.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path in the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def rename_path(spark: SparkSession, path: str, target: str) -> None:
    """Move a file or folder; the folder above the target is made."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, target))
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise FileExistsError(f"{path} could not be moved to {target}")


# Folders that ``materialize`` made, by application.
_INTERMEDIATES: dict[str, list[str]] = {}


def remove_intermediates(spark: SparkSession) -> int:
    """Remove what ``materialize`` wrote in this application. DataFrames that read it can
    no longer be used, so keep results elsewhere first."""
    paths = _INTERMEDIATES.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove_path(spark, path)
    return len(paths)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, fixes values that a recomputation
    could change, and gives the planner the true size: a join against the result
    is broadcast only if the written files are below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffled otherwise.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    _INTERMEDIATES.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BLOCK_BYTES = 1 << 20  # of input, below which more blocks are of no use


def block_count(df: DataFrame) -> int:
    """How many range partitions to make of ``df``: as the session's shuffles begin with,
    or fewer where the planner's estimate of the size says so."""
    conf = df.sparkSession.conf
    most = int(conf.get("spark.sql.shuffle.partitions"))
    if conf.get("spark.sql.adaptive.coalescePartitions.enabled") != "true":
        return most
    most = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or most)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    target = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    few = min(df.sparkSession.sparkContext.defaultParallelism, -(-size // BLOCK_BYTES))
    # files are smaller than the rows in them
    return max(1, min(most, max(few, -(-4 * size // target))))


_MARKS: dict[int, list[int]] = {}


def _marks(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` buckets, a number that Spark's hash puts into it."""
    if n not in _MARKS:
        numbers = spark.range(max(64, 32 * n)).select(F.col("id").cast("int").alias("mark"))
        found = numbers.groupBy(F.pmod(F.hash("mark"), F.lit(n)).alias("bucket")).agg(F.min("mark").alias("mark"))
        _MARKS[n] = [r["mark"] for r in found.orderBy("bucket").collect()]
    return _MARKS[n]


def materialize_blocks(
    df: DataFrame,
    label: str,
    sorts: list[Column],
    block: str,
    bucket: str,
    blocks: int | None = None,
    nth: str | None = None,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Range-partition ``df`` by ``sorts`` and write a file for each partition, numbered by
    ``block`` in order. It is read back as bucketed by ``bucket``, one bucket a block: what
    is grouped or windowed by both columns needs no further shuffle. ``nth`` names a column
    for the number of a row in its block, from 0 in the order of ``sorts``; columns to
    ``drop`` serve the order only.

    Like ``materialize``, it cuts the lineage. The table's name goes at once; the files stay
    as long as those of ``materialize``.
    """
    spark = df.sparkSession
    n = blocks or block_count(df)
    marks = F.array(*[F.lit(m) for m in _marks(spark, n)])
    rows = df.repartitionByRange(n, *sorts).withColumn(block, F.spark_partition_id())
    rows = rows.withColumn(bucket, F.element_at(marks, F.pmod(F.col(block), F.lit(n)) + 1))
    if nth:
        rows = rows.sortWithinPartitions(*sorts)
        rows = rows.withColumn(nth, F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)))
    rows = rows.drop(*drop)
    path = shared_dir(spark, label)
    _INTERMEDIATES.setdefault(spark.sparkContext.applicationId, []).append(path)
    name = f"spark_catalog.default.{label}_{uuid.uuid4().hex}"
    rows.write.format("parquet").bucketBy(n, bucket).option("path", path).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
