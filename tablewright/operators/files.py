"""File-index operators on a manifest ``(file_id, file_name, size, added_at, md5_hash)``.

Everything is a row operation or an aggregation that combines before the shuffle; a
directory with a third of all files stays rows and never becomes one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import materialize
from tablewright.sources.files import list_files as list_files_at
from tablewright.sources.files import stream_hashes

MODES = ("all", "files", "directories")
# Fixed value: shape of the older file ids, two words of 4 and 9 characters and a suffix.
LEGACY_ID = r"^[^.\-]{4}-[^.\-]{9}\.[^.]+$"


def rename_index(df: DataFrame, file_id: str = "file_id", file_name: str = "file_name") -> DataFrame:
    """A manifest from a table whose id and name columns have other names."""
    return df.withColumnsRenamed({file_id: "file_id", file_name: "file_name"})


# --- paths -------------------------------------------------------------------


def normalize_path(path: Column | str) -> Column:
    """Without leading and trailing slashes."""
    path = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(path, "^/+|/+$", "")


def path_parts(path: Column | str) -> Column:
    path = F.col(path) if isinstance(path, str) else path
    return F.filter(F.split(path, "/"), lambda p: p != "")


def parent_path(parts: Column) -> Column:
    return F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/")


def ancestors(parts: Column) -> Column:
    """Paths of all directories above a file, without the root."""
    # the guard matters: a sequence from 1 to 0 counts down
    return F.when(
        F.size(parts) > 1,
        F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")),
    ).otherwise(F.array().cast("array<string>"))


# --- tree --------------------------------------------------------------------


def latest_files(manifest: DataFrame) -> DataFrame:
    """One row per path: of files added under one path the last wins."""
    parts = path_parts("file_name")
    newest = F.max_by(F.struct(*manifest.columns), F.struct("added_at", "file_id"))
    return (
        manifest.where(F.size(parts) > 0)
        .groupBy(F.array_join(parts, "/").alias("path"))
        .agg(newest.alias("_f"))
        .select("path", "_f.*")
    )


def dir_tree(manifest: DataFrame) -> DataFrame:
    """All nodes: ``path, name, parent, depth, is_dir, file_id, size, md5_hash``.

    A path that is both a file and a directory gives both nodes; the root is not a node.
    """
    files = latest_files(manifest)
    parts = path_parts("path")
    file_nodes = files.select(
        "path", F.lit(False).alias("is_dir"), "file_id", "size", "added_at", "md5_hash"
    )
    dir_nodes = (
        files.select(F.explode(ancestors(parts)).alias("path")).distinct().withColumn("is_dir", F.lit(True))
    )
    nodes = file_nodes.unionByName(dir_nodes, allowMissingColumns=True)
    return nodes.select(
        "path",
        F.element_at(parts, -1).alias("name"),
        parent_path(parts).alias("parent"),
        F.size(parts).alias("depth"),
        "is_dir",
        "file_id",
        "size",
        "added_at",
        "md5_hash",
    )


def list_nodes(
    manifest: DataFrame,
    directory: str = "",
    mode: str = "all",
    recursive: bool = False,
    max_results: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Listing below a directory: names in order, depth first, a directory before its content."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    root = "/".join(p for p in directory.split("/") if p)
    if root:  # only files below can give nodes below
        whole = F.array_join(path_parts("file_name"), "/")
        manifest = manifest.where(F.startswith(whole, F.lit(root + "/")))
    nodes = dir_tree(manifest)
    if mode != "all":
        nodes = nodes.where(F.col("is_dir") if mode == "directories" else ~F.col("is_dir"))
    if not recursive:
        nodes = nodes.where(F.col("parent") == root)
    elif root:
        nodes = nodes.where(F.startswith("path", F.lit(root + "/")))
    if ordered or max_results is not None:
        nodes = nodes.orderBy(F.split("path", "/"), F.desc("is_dir"))
    return nodes if max_results is None else nodes.limit(max_results)


def list_files(manifest: DataFrame, max_results: int | None = None) -> DataFrame:
    """All files of a table."""
    return list_nodes(manifest, mode="files", recursive=True, max_results=max_results)


def dir_children(manifest: DataFrame) -> DataFrame:
    """Immediate children per directory as rows ``parent, name, is_dir``."""
    return dir_tree(manifest).select("parent", "name", "is_dir")


def dir_sizes(manifest: DataFrame) -> DataFrame:
    """Files and bytes below each directory (the root is the empty path)."""
    files = latest_files(manifest)
    above = F.concat(F.array(F.lit("")), ancestors(path_parts("path")))
    return (
        files.select(F.explode(above).alias("path"), F.coalesce("size", F.lit(0)).alias("size"))
        .groupBy("path")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("total_bytes"))
    )


# --- lookup ------------------------------------------------------------------


def _walk(parts: Column) -> Column:
    """Follow the parts: where they lead, which directories they pass, and an error flag.

    ``must`` collects the paths that have to be directories because the walk leaves them
    by ``..`` or names them by ``.``.
    """
    start = F.struct(
        F.array().cast("array<string>").alias("at"),
        F.array().cast("array<string>").alias("must"),
        F.lit(False).alias("above"),
    )

    def step(acc: Column, part: Column) -> Column:
        at, must, above = acc["at"], acc["must"], acc["above"]
        size = F.size(at)
        here = F.array_append(must, F.array_join(at, "/"))
        stay = F.struct(at.alias("at"), must.alias("must"), above.alias("above"))
        return (
            F.when(above, stay)
            .when(
                part == ".",
                F.struct(at.alias("at"), F.when(size > 0, here).otherwise(must).alias("must"), above.alias("above")),
            )
            .when(
                (part == "..") & (size == 0),
                F.struct(at.alias("at"), must.alias("must"), F.lit(True).alias("above")),
            )
            .when(
                part == "..",
                F.struct(F.slice(at, F.lit(1), size - 1).alias("at"), here.alias("must"), above.alias("above")),
            )
            .otherwise(F.struct(F.array_append(at, part).alias("at"), must.alias("must"), above.alias("above")))
        )

    return F.aggregate(parts, start, step)


def resolve_paths(requests: DataFrame, manifest: DataFrame, path: str = "path") -> DataFrame:
    """Look up many paths at once.

    Adds ``status`` (``file``, ``directory``, ``missing``, or ``error`` for a path that
    climbs above the root), ``resolved`` and ``file_id``. Handles absolute paths, ``.``,
    ``..``, a trailing slash (directory only), and file ids of the older form.
    """
    # used twice, and with its true size known small trees are broadcast
    tree = materialize(
        dir_tree(manifest)
        .groupBy("path")
        .agg(F.bool_or("is_dir").alias("_has_dir"), F.max("file_id").alias("_file_id"))
        .withColumnRenamed("path", "_node"),
        "tree",
    )
    asked, parts = F.col(path), path_parts(path)
    by_id = F.coalesce(asked.rlike(LEGACY_ID), F.lit(False))
    dots = F.coalesce(F.exists(parts, lambda p: p.isin(".", "..")), F.lit(False))
    # each kind has a join of its own, on a key that all of its rows have
    plain = requests.where(~by_id & ~dots).withColumns({"_target": F.array_join(parts, "/"), "_dir_only": asked.endswith("/")})
    plain = _answered(plain.join(tree, F.col("_target") == F.col("_node"), "left"), requests.columns, asked.isNull())
    walked = _walked(requests.where(~by_id & dots), tree, path)
    ids = manifest.select(F.col("file_id").alias("_id"), F.array_join(path_parts("file_name"), "/").alias("_id_path"))
    ids = ids.groupBy("_id").agg(F.min("_id_path").alias("_id_path"))
    named = requests.where(by_id).join(ids, asked == F.col("_id"), "left").select(
        *requests.columns,
        F.when(F.col("_id").isNotNull(), "file").otherwise("missing").alias("status"),
        F.col("_id_path").alias("resolved"),
        F.col("_id").alias("file_id"),
    )
    return plain.unionByName(walked).unionByName(named)


def _answered(found: DataFrame, columns: list[str], unknown: Column, *before: tuple[Column, str]) -> DataFrame:
    """Status by the node that a target met; ``before`` are conditions that come first."""
    status = F.when(unknown, F.lit(None).cast("string"))
    for condition, value in before:
        status = status.when(condition, value)
    status = (
        status.when(F.col("_target") == "", "directory")
        .when(F.col("_file_id").isNotNull() & ~F.col("_dir_only"), "file")
        .when(F.coalesce("_has_dir", F.lit(False)), "directory")
        .otherwise("missing")
    )
    found = found.withColumn("_status", status)
    hit = F.col("_status").isin("file", "directory")
    return found.select(
        *columns,
        F.col("_status").alias("status"),
        F.when(hit, F.col("_target")).alias("resolved"),
        F.when(F.col("_status") == "file", F.col("_file_id")).alias("file_id"),
    )


def _walked(requests: DataFrame, tree: DataFrame, path: str) -> DataFrame:
    """Paths with dots: every directory that they pass has to exist."""
    asked = requests.select(F.col(path).alias("_asked")).distinct().withColumn("_w", _walk(path_parts("_asked")))
    ends = F.element_at(path_parts("_asked"), -1).isin(".", "..")
    asked = asked.select(
        "_asked",
        F.array_join("_w.at", "/").alias("_target"),
        F.col("_w.must").alias("_must"),
        F.col("_w.above").alias("_above"),
        (F.col("_asked").endswith("/") | ends).alias("_dir_only"),
    )
    passed = (
        asked.select("_asked", F.explode(F.array_distinct("_must")).alias("_node"))
        .join(tree.where("_has_dir").select("_node", F.lit(1).alias("_is_dir")), "_node", "left")
        .groupBy("_asked")
        .agg((F.count("_is_dir") < F.count(F.lit(1))).alias("_lost"))
    )
    found = asked.join(tree, F.col("_target") == F.col("_node"), "left").join(passed, "_asked", "left")
    lost, above = F.coalesce("_lost", F.lit(False)), F.col("_above")
    answers = _answered(found, ["_asked"], F.lit(False), (lost, "missing"), (above, "error"))
    return requests.join(answers, F.col(path) == F.col("_asked"), "left").drop("_asked")


def lookup_files(requests: DataFrame, manifest: DataFrame, path: str = "path") -> DataFrame:
    """Paths that have to be files: adds ``file_id`` and ``problem`` (null when found)."""
    found = resolve_paths(requests, manifest, path)
    return found.select(
        *requests.columns,
        "file_id",
        F.when(F.col("status") == "directory", F.lit("is a directory, not a file"))
        .when(F.col("status") == "missing", F.lit("no file found"))
        .when(F.col("status") == "error", F.lit("path traverses above the root directory"))
        .alias("problem"),
    )


def lookup_file_ids(requests: DataFrame, manifest: DataFrame, file_id: str = "file_id") -> DataFrame:
    """Requests by id, with the file's name; unknown ids keep a null name."""
    known = manifest.select(F.col("file_id").alias("_id"), "file_name", "size", "md5_hash")
    return requests.join(known, requests[file_id] == known["_id"], "left").drop("_id")


# --- copies ------------------------------------------------------------------


def sync_plan(source: DataFrame, target: DataFrame, overwrite: bool = False) -> DataFrame:
    """What copying ``source`` over ``target`` does to each path.

    ``copy`` if the target lacks it, ``skip`` on equal size and hash, else ``overwrite``
    or ``error``. A source without size or hash never counts as equal.
    """
    have = latest_files(target).select(
        F.col("path").alias("_path"), F.col("size").alias("_size"), F.col("md5_hash").alias("_md5")
    )
    want = latest_files(source)
    same = (F.col("size") == F.col("_size")) & (F.col("md5_hash") == F.col("_md5"))
    action = (
        F.when(F.col("_path").isNull(), "copy")
        .when(F.coalesce(same, F.lit(False)), "skip")
        .otherwise("overwrite" if overwrite else "error")
    )
    return want.join(have, want["path"] == have["_path"], "left").select(
        "path", "file_id", "size", "md5_hash", action.alias("action")
    )


def files_to_copy(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source files that are not at the target with equal size and hash."""
    want = latest_files(source)
    have = latest_files(target).select("path", "size", "md5_hash")
    return want.join(have, ["path", "size", "md5_hash"], "left_anti")


def download_paths(manifest: DataFrame, root: str, directory: str = "") -> DataFrame:
    """Files below a directory with their ``target`` under a download root."""
    base = "/".join(p for p in directory.split("/") if p)
    files = list_nodes(manifest, directory=base, mode="files", recursive=True, ordered=False)
    relative = F.substr("path", F.lit(len(base) + 2)) if base else F.col("path")
    return files.select(
        "file_id", "path", "size", "md5_hash", F.concat(F.lit(root.rstrip("/") + "/"), relative).alias("target")
    )


def file_target(file_name: Column | str, target: str, is_dir: bool) -> Column:
    """Where one downloaded file goes: a directory target keeps the file's name."""
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    if is_dir or target.endswith("/"):
        return F.concat(F.lit(target.rstrip("/") + "/"), name)
    return F.lit(target)


# --- content -----------------------------------------------------------------


def content_hash(content: Column | str) -> Column:
    """Base64 of the raw md5 of the bytes."""
    return F.base64(F.unhex(F.md5(content)))


def file_hashes(files: DataFrame, content: str = "content") -> DataFrame:
    """Size and hash of each file in place of its content."""
    keep = [c for c in files.columns if c not in (content, "size", "md5_hash")]
    return files.select(
        *keep,
        F.octet_length(content).cast("bigint").alias("size"),
        content_hash(F.col(content).cast("binary")).alias("md5_hash"),
    )


def read_range(
    content: Column | str, start_byte: int = 0, end_byte: int | None = None, as_text: bool = False
) -> Column:
    """Bytes ``start_byte`` to ``end_byte`` (inclusive; the whole rest without it)."""
    content = F.col(content) if isinstance(content, str) else content
    if end_byte is None:
        part = F.substr(content, F.lit(start_byte + 1))
    else:
        part = F.substr(content, F.lit(start_byte + 1), F.lit(max(end_byte - start_byte + 1, 0)))
    return F.decode(part, "UTF-8") if as_text else part


def build_manifest(files: DataFrame, added_at: Column, file_id: Column | None = None) -> DataFrame:
    """Manifest rows for raw files ``(name, content)``; ids default to the hash of the name."""
    return files.select(
        (file_id if file_id is not None else F.md5("name")).alias("file_id"),
        F.col("name").alias("file_name"),
        F.octet_length("content").cast("bigint").alias("size"),
        added_at.alias("added_at"),
        content_hash("content").alias("md5_hash"),
    )


def add_files(
    spark: SparkSession,
    table_path: str,
    added_at: Column,
    directory: str | None = None,
    files: DataFrame | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Register files in the manifest at ``table_path`` and return their rows: those below a
    ``directory``, hashed in tasks, or given ones ``(name, content)``, exactly one of both."""
    if (directory is None) == (files is None):
        raise ValueError("give a directory or files, not both")
    if directory is not None:
        found = stream_hashes(list_files_at(spark, directory, glob), directory)
        columns = [F.md5("name").alias("file_id"), F.col("name").alias("file_name"), "size", added_at.alias("added_at"), "md5_hash"]
        rows = found.select(*columns)
    else:
        rows = build_manifest(files, added_at)
    rows = materialize(rows, "registered")
    rows.write.mode("append").parquet(table_path)
    return rows
