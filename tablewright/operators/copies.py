"""Copying the files of a manifest, with verified hashes."""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.files import latest_files, sync_plan
from tablewright.session import materialize, path_exists
from tablewright.sources.files import TASK_BYTES, list_files, open_filesystem, stream_hashes


def manifest_of(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """The manifest of a directory as it is; file ids are the names."""
    return _as_manifest(stream_hashes(list_files(spark, directory, glob), directory))


def _as_manifest(files: DataFrame) -> DataFrame:
    name = F.col("name")
    return files.select(name.alias("file_id"), name.alias("file_name"), "size", F.col("modified_at").alias("added_at"), "md5_hash")


def _there(manifest: DataFrame, target: str) -> DataFrame:
    """What the target has under the manifest's paths; only files of equal size, which
    could be the same, are read for their hash."""
    wanted = latest_files(manifest).select(F.col("path").alias("name"), F.col("size").alias("_size"))
    found = materialize(list_files(manifest.sparkSession, target).join(wanted, "name"), "present")
    same = F.col("size") == F.coalesce("_size", F.lit(-1))
    equal = stream_hashes(found.where(same).drop("_size"), target)
    other = found.where(~same).drop("_size").withColumn("md5_hash", F.lit(None).cast("string"))
    return _as_manifest(equal.unionByName(other))


def copy_files(manifest: DataFrame, source: str, target: str, overwrite: bool = False) -> DataFrame:
    """Copy the manifest's files from one root to another and give ``path, size, action``.

    Files already there with equal size and hash are skipped; others there are an error,
    found before anything is copied, unless ``overwrite``. Tasks stream each file, so its
    size does not matter, to a new name that replaces the target once it is whole and its
    hash is the manifest's. A repeated task does the same again.
    """
    spark = manifest.sparkSession
    if path_exists(spark, target):
        have = _there(manifest, target)
    else:
        have = manifest.limit(0)
    plan = materialize(sync_plan(manifest, have, overwrite), "copies")
    if not plan.where("action = 'error'").isEmpty():
        raise FileExistsError(f"other files exist below {target}; set overwrite to replace them")
    todo = plan.where("action <> 'skip'").select("path", "md5_hash")
    volume = plan.where("action <> 'skip'").agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, -(-volume // TASK_BYTES))

    (from_fs, from_root), (to_fs, to_root) = open_filesystem(source), open_filesystem(target)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{to_root}/{row['path']}"
                part = f"{path}.{uuid.uuid4().hex}.part"
                to_fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                digest = hashlib.md5()
                with from_fs.open_input_stream(f"{from_root}/{row['path']}") as reader:
                    with to_fs.open_output_stream(part) as writer:
                        while block := reader.read(1 << 22):
                            digest.update(block)
                            writer.write(block)
                found = base64.b64encode(digest.digest()).decode()
                if row["md5_hash"] not in (None, found):
                    to_fs.delete_file(part)
                    raise IOError(f"{row['path']}: hash {found} instead of {row['md5_hash']}")
                to_fs.move(part, path)
            yield batch

    # written, so that the copying happens once and here
    materialize(todo.repartition(tasks).mapInArrow(copy, todo.schema), "copied")
    return plan.select("path", "size", "action")
