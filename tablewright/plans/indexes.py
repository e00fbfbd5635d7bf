"""File-index queries on a manifest made from the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators import files as fo
from tablewright.plans.registry import register, table
from tablewright.session import shared_dir
from tablewright.sources import files as raw


def _added(day: int):
    return F.lit(f"2024-01-0{day}").cast("timestamp_ntz")


def _entries(df: DataFrame, file_id, content, day: int) -> DataFrame:
    name = F.concat_ws("/", "source", "lang", F.concat("doc_id", F.lit(".txt")))
    specs = df.select("doc_id", name.alias("name"), F.encode(content, "UTF-8").alias("content"), file_id.alias("_id"))
    return fo.build_manifest(specs, _added(day), F.col("_id"))


def _manifest(spark, sf_dir) -> DataFrame:
    """Each document, and a later edition under the same path of those with labels."""
    docs = table(spark, sf_dir, "documents")
    again = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return _entries(docs, F.concat(F.lit("d"), "doc_id"), F.col("text"), 1).unionByName(
        _entries(again, F.concat(F.lit("r"), "doc_id"), F.concat("text", F.lit("!")), 2)
    )


_NAME = "source || '/' || lang || '/' || doc_id || '.txt'"
# the latest edition per path
_FILES = f"""
    WITH f AS (
        SELECT {_NAME} AS path, source, lang, doc_id,
               CASE WHEN q.doc_id IS NULL THEN 'd' ELSE 'r' END || CAST(doc_id AS VARCHAR) AS file_id,
               CASE WHEN q.doc_id IS NULL THEN text ELSE text || '!' END AS content
        FROM documents LEFT JOIN (SELECT DISTINCT doc_id FROM labels) q USING (doc_id)
    )
"""
_DIRS = "SELECT DISTINCT source AS path FROM f UNION SELECT DISTINCT source || '/' || lang FROM f"


@register(
    "file_index",
    f"""SELECT 'd' || CAST(doc_id AS VARCHAR) AS file_id, {_NAME} AS file_name, STRLEN(text) AS size,
        TO_BASE64(UNHEX(MD5(text))) AS md5_hash FROM documents""",
)
def file_index(spark, sf_dir):
    """A table whose id and name columns have other names."""
    entries = _entries(table(spark, sf_dir, "documents"), F.concat(F.lit("d"), "doc_id"), F.col("text"), 1)
    other = entries.withColumnsRenamed({"file_id": "key", "file_name": "label"})
    return fo.rename_index(other, "key", "label").drop("added_at")


def _written(spark, sf_dir) -> str:
    """A directory with one file for each source and language: its texts by id, a line
    break after each."""
    path = shared_dir(spark, "files")
    docs = table(spark, sf_dir, "documents").repartition("source", "lang").sortWithinPartitions("source", "lang", "doc_id")
    docs.select("text", "source", "lang").write.partitionBy("source", "lang").text(path)
    return path


def _place(name: str) -> list:
    """The source and language in a file's name."""
    parts = F.split(name, "/")
    return [F.regexp_replace(parts[0], "^source=", "").alias("source"), F.regexp_replace(parts[1], "^lang=", "").alias("lang")]


_WRITTEN = """
    WITH w AS (SELECT source, lang, STRING_AGG(text || CHR(10), '' ORDER BY doc_id) AS content FROM documents GROUP BY source, lang)
"""


@register("file_hashes", _WRITTEN + "SELECT source, lang, STRLEN(content) AS size, TO_BASE64(UNHEX(MD5(content))) AS md5_hash FROM w")
def file_hashes(spark, sf_dir):
    path = _written(spark, sf_dir)
    return raw.stream_hashes(raw.list_files(spark, path, "*.txt"), path).select(*_place("name"), "size", "md5_hash")


@register(
    "add_files",
    _WRITTEN + "SELECT source, lang, STRLEN(content) AS size, TO_BASE64(UNHEX(MD5(content))) AS md5_hash, TRUE AS named FROM w",
)
def add_files(spark, sf_dir):
    """The files of a directory into a stored manifest."""
    path, stored = _written(spark, sf_dir), shared_dir(spark, "manifest")
    fo.add_files(spark, stored, _added(1), directory=path, glob="*.{txt,csv}")
    named = (F.col("file_id") == F.md5("file_name")).alias("named")
    return spark.read.parquet(stored).select(*_place("file_name"), "size", "md5_hash", named)


@register(
    "file_read_range",
    _WRITTEN
    + """
    SELECT source, lang, UNHEX(SUBSTR(HEX(ENCODE(content)), 1, 200)) AS head,
           MD5(UNHEX(SUBSTR(HEX(ENCODE(content)), 41))) AS rest, UNHEX(SUBSTR(HEX(ENCODE(content)), 20001, 40)) AS inner_part
    FROM w
    """,
)
def file_read_range(spark, sf_dir):
    """Bytes 0 to 99, bytes from 20 on, and bytes 10000 to 10019, of which short files have none."""
    path = _written(spark, sf_dir)
    out = raw.list_files(spark, path, "*.txt")
    for name, first, last in (("head", 0, 99), ("inner_part", 10_000, 10_019)):
        out = raw.stream_range(out, path, first, last, name)
    # an open range may be larger than a cell
    out = raw.stream_hashes(out, path, 20, "rest")
    return out.select(*_place("name"), "head", F.lower(F.hex(F.unbase64("rest"))).alias("rest"), "inner_part")


BLOCK = 2000  # consecutive ids of a file at most


def _bounded(spark, sf_dir) -> str:
    """A directory with many files for each source and language, none of more than BLOCK
    texts: their number grows with the documents, not their size."""
    path = shared_dir(spark, "files")
    docs = table(spark, sf_dir, "documents").select("text", "source", "lang", "doc_id", F.floor(F.col("doc_id") / BLOCK).alias("block"))
    docs = docs.repartition("source", "lang", "block").sortWithinPartitions("source", "lang", "block", "doc_id")
    docs.drop("doc_id").write.partitionBy("source", "lang", "block").text(path)
    return path


def _block(name: str):
    return F.regexp_extract(name, "block=([0-9]+)", 1).cast("bigint").alias("block")


_BOUNDED = f"""
    WITH w AS (SELECT source, lang, CAST(doc_id // {BLOCK} AS BIGINT) AS block, STRING_AGG(text || CHR(10), '' ORDER BY doc_id) AS content
               FROM documents GROUP BY ALL),
    p AS (SELECT source, lang, block, STRLEN(content) AS size, part, MD5(UNHEX(SUBSTR(HEX(ENCODE(content)), 2 * part * 4096 + 1, 8192))) AS part_md5
          FROM (SELECT *, UNNEST(RANGE(GREATEST((STRLEN(content) + 4095) // 4096, 1))) AS part FROM w))
"""


@register("file_part_hashes", _BOUNDED + "SELECT source, lang, block, part, part_md5 FROM p")
def file_part_hashes(spark, sf_dir):
    """Many files, each hashed by parts."""
    path = _bounded(spark, sf_dir)
    parts = raw.part_hashes(raw.list_files(spark, path, "*.txt"), path, 4096)
    return parts.select(*_place("name"), _block("name"), "part", "part_md5")


@register(
    "file_tree_hashes",
    _BOUNDED + "SELECT source, lang, block, size, MD5(STRING_AGG(part_md5, '' ORDER BY part)) AS tree_md5 FROM p GROUP BY ALL",
)
def file_tree_hashes(spark, sf_dir):
    path = _bounded(spark, sf_dir)
    found = raw.tree_hashes(raw.list_files(spark, path, "*.txt"), path, 4096)
    return found.select(*_place("name"), _block("name"), "size", "tree_md5")


@register(
    "file_ranges",
    _BOUNDED.split("p AS")[0].rstrip().rstrip(",")
    + """
    SELECT source, lang, block, UNHEX(SUBSTR(HEX(ENCODE(content)), 1, 200)) AS head, UNHEX(SUBSTR(HEX(ENCODE(content)), 20001, 40)) AS inner_part
    FROM w
    """,
)
def file_ranges(spark, sf_dir):
    """Byte ranges of many files."""
    path = _bounded(spark, sf_dir)
    out = raw.list_files(spark, path, "*.txt")
    for name, first, last in (("head", 0, 99), ("inner_part", 10_000, 10_019)):
        out = raw.stream_range(out, path, first, last, name)
    return out.select(*_place("name"), _block("name"), "head", "inner_part")


# --- tree and listings


@register(
    "path_parts",
    f"SELECT doc_id, {_NAME} AS normal, lang AS second, 3 AS n_parts FROM documents",
)
def path_parts(spark, sf_dir):
    path = F.concat(F.lit("//"), "source", F.lit("/"), "lang", F.lit("//"), "doc_id", F.lit(".txt/"))
    parts = fo.path_parts(fo.normalize_path(path))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(parts, "/").alias("normal"), parts[1].alias("second"), F.size(parts).alias("n_parts")
    )


@register(
    "dir_tree",
    _FILES
    + """
    SELECT path, doc_id || '.txt' AS name, source || '/' || lang AS parent, 3 AS depth, FALSE AS is_dir, file_id,
           STRLEN(content) AS size FROM f
    UNION ALL SELECT DISTINCT source, source, '', 1, TRUE, NULL, NULL FROM f
    UNION ALL SELECT DISTINCT source || '/' || lang, lang, source, 2, TRUE, NULL, NULL FROM f
    """,
)
def dir_tree(spark, sf_dir):
    return fo.dir_tree(_manifest(spark, sf_dir)).drop("md5_hash", "added_at")


@register("list_files", _FILES + "SELECT path, file_id FROM f WHERE source = 'src1'")
def list_files(spark, sf_dir):
    """All files below one directory."""
    return fo.list_nodes(_manifest(spark, sf_dir), "/src1/", mode="files", recursive=True).select("path", "file_id")


@register("list_dirs", _FILES + _DIRS)
def list_dirs(spark, sf_dir):
    return fo.list_nodes(_manifest(spark, sf_dir), mode="directories", recursive=True).select("path")


@register("list_all", _FILES + f"SELECT path, TRUE AS is_dir FROM ({_DIRS}) UNION ALL SELECT path, FALSE FROM f")
def list_all(spark, sf_dir):
    return fo.list_nodes(_manifest(spark, sf_dir), mode="all", recursive=True).select("path", "is_dir")


@register(
    "list_first",
    _FILES
    + f"""
    SELECT path, is_dir FROM (SELECT path, TRUE AS is_dir FROM ({_DIRS}) UNION ALL SELECT path, FALSE FROM f)
    ORDER BY STRING_SPLIT(path, '/') LIMIT 50
    """,
)
def list_first(spark, sf_dir):
    """The first 50 nodes in listing order."""
    nodes = fo.list_nodes(_manifest(spark, sf_dir), mode="all", recursive=True, max_results=50)
    return nodes.select("path", "is_dir")


@register("list_table_files", _FILES + "SELECT path, file_id, STRLEN(content) AS size FROM f")
def list_table_files(spark, sf_dir):
    return fo.list_files(_manifest(spark, sf_dir)).select("path", "file_id", "size")


@register(
    "dir_children",
    _FILES
    + """
    SELECT source || '/' || lang AS parent, doc_id || '.txt' AS name, FALSE AS is_dir FROM f
    UNION ALL SELECT DISTINCT '', source, TRUE FROM f
    UNION ALL SELECT DISTINCT source, lang, TRUE FROM f
    """,
)
def dir_children(spark, sf_dir):
    return fo.dir_children(_manifest(spark, sf_dir))


@register(
    "dir_sizes",
    _FILES
    + """
    SELECT path, COUNT(*) AS n_files, CAST(SUM(STRLEN(content)) AS BIGINT) AS total_bytes FROM (
        SELECT '' AS path, content FROM f UNION ALL SELECT source, content FROM f
        UNION ALL SELECT source || '/' || lang, content FROM f) GROUP BY path
    """,
)
def dir_sizes(spark, sf_dir):
    return fo.dir_sizes(_manifest(spark, sf_dir))


# --- lookup

# way of asking -> (path of a document in that form, status, whether it gives the file)
_ASKED = {
    "plain": ("{s}/{l}/{d}.txt", "file"),
    "absolute": ("/{s}//{l}/{d}.txt", "file"),
    "dotted": ("./{s}/{l}/../{l}/./{d}.txt", "file"),
    "slash": ("{s}/{l}/{d}.txt/", "missing"),
    "through_file": ("{s}/{l}/{d}.txt/../{d}.txt", "missing"),
    "through_nothing": ("{s}/nothing/../{l}/{d}.txt", "missing"),
    "folder": ("/{s}/{l}/", "directory"),
    "up": ("{s}/{l}/..", "directory"),
    "above": ("{s}/../../{d}.txt", "error"),
    "absent": ("{s}/{l}/{d}.csv", "missing"),
}


def _requests(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")

    def filled(form: str):
        made = F.lit(form)
        for slot, column in (("{s}", "source"), ("{l}", "lang"), ("{d}", "doc_id")):
            made = F.replace(made, F.lit(slot), F.col(column).cast("string"))
        return made

    forms = F.array(*[F.struct(F.lit(k).alias("form"), filled(p).alias("path")) for k, (p, _) in _ASKED.items()])
    return docs.select("doc_id", F.inline(forms))


_REQUESTS_SQL = " UNION ALL ".join(
    f"SELECT doc_id, source, lang, file_id, '{k}' AS form, '{status}' AS status, "
    f"REPLACE(REPLACE(REPLACE('{p}', '{{s}}', source), '{{l}}', lang), '{{d}}', CAST(doc_id AS VARCHAR)) AS path FROM f"
    for k, (p, status) in _ASKED.items()
)


@register(
    "resolve_paths",
    _FILES
    + f"""
    SELECT doc_id, form, path, status, CASE WHEN status = 'file' THEN file_id END AS file_id,
           CASE WHEN status = 'file' THEN {_NAME} WHEN form = 'folder' THEN source || '/' || lang
                WHEN form = 'up' THEN source END AS resolved
    FROM ({_REQUESTS_SQL})
    """,
)
def resolve_paths(spark, sf_dir):
    return fo.resolve_paths(_requests(spark, sf_dir), _manifest(spark, sf_dir))


@register(
    "lookup_files",
    _FILES
    + f"""
    SELECT doc_id, form, path, CASE WHEN status = 'file' THEN file_id END AS file_id,
           CASE status WHEN 'directory' THEN 'is a directory, not a file' WHEN 'missing' THEN 'no file found'
                WHEN 'error' THEN 'path traverses above the root directory' END AS problem
    FROM ({_REQUESTS_SQL})
    """,
)
def lookup_files(spark, sf_dir):
    return fo.lookup_files(_requests(spark, sf_dir), _manifest(spark, sf_dir))


_LEGACY_SQL = "'fidx-' || LPAD(CAST(doc_id AS VARCHAR), 9, '0') || '.' || SUBSTR(MD5(text), 1, 8)"


@register(
    "lookup_file_ids",
    f"""
    SELECT {_LEGACY_SQL} AS path, 'file' AS status, {_NAME} AS resolved FROM documents
    UNION ALL SELECT 'none-' || LPAD(CAST(doc_id AS VARCHAR), 9, '0') || '.x', 'missing', NULL FROM labels
    """,
)
def lookup_file_ids(spark, sf_dir):
    """Files asked for by ids of the older form, some of them unknown."""
    docs = table(spark, sf_dir, "documents")
    number = F.lpad(F.col("doc_id").cast("string"), 9, "0")
    key = F.concat(F.lit("fidx-"), number, F.lit("."), F.substring(F.md5("text"), 1, 8))
    manifest = _entries(docs, key, F.col("text"), 1)
    unknown = table(spark, sf_dir, "labels").select(F.concat(F.lit("none-"), number, F.lit(".x")).alias("path"))
    asked = docs.select(key.alias("path")).unionByName(unknown)
    return fo.resolve_paths(asked, manifest).drop("file_id")


# --- copies


@register(
    "sync_plan",
    f"""
    SELECT {_NAME} AS path, CASE WHEN quality IS NULL THEN 'copy' WHEN quality = 1 THEN 'skip' ELSE 'error' END AS action
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def sync_plan(spark, sf_dir):
    """The target lacks documents without labels and has other bytes for those of low quality."""
    docs = table(spark, sf_dir, "documents")
    have = docs.join(table(spark, sf_dir, "labels"), "doc_id")
    target = F.when(F.col("quality") == 1, F.col("text")).otherwise(F.concat("text", F.lit("~")))
    plan = fo.sync_plan(
        _entries(docs, F.concat(F.lit("d"), "doc_id"), F.col("text"), 1),
        _entries(have, F.concat(F.lit("t"), "doc_id"), target, 1),
    )
    return plan.select("path", "action")


@register(
    "files_to_copy",
    f"SELECT {_NAME} AS path, STRLEN(text) AS size FROM documents LEFT JOIN labels USING (doc_id) "
    "WHERE quality IS NULL",
)
def files_to_copy(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    have = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    source, target = (_entries(d, F.concat(F.lit("d"), "doc_id"), F.col("text"), 1) for d in (docs, have))
    return fo.files_to_copy(source, target).select("path", "size")


@register(
    "download_paths",
    _FILES + "SELECT file_id, '/downloads/' || lang || '/' || doc_id || '.txt' AS target FROM f WHERE source = 'src7'",
)
def download_paths(spark, sf_dir):
    return fo.download_paths(_manifest(spark, sf_dir), "/downloads/", "/src7").select("file_id", "target")
