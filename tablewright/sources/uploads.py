"""A table made of uploads, each with its own schema.

Every upload is written to a new folder. It becomes part of the table when one record is
committed to the table's log, so readers see whole uploads only, a failed or repeated task
leaves nothing visible, and no released file is ever overwritten. Several writers may
upload at a time: a commit decides again on what the others have done.

Many small uploads, as a stream makes them, can be merged into one folder; that too becomes
visible by one record, and names, rows and their order stay.

Statistics are kept by upload: those of a table merge what its uploads have, and only
uploads without them are read.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.profile import SUMMARY, merge_summaries, summarize
from tablewright.operators.schema import merge_uploads, union_schema
from tablewright.operators.sinks import write_verified
from tablewright.session import remove_path, rename_path
from tablewright.sources.log import RecordLog

UPLOAD_COLUMN = "_upload"
STRATEGIES = ("append", "replace")
SMALL_ROWS = 1_000_000  # uploads of fewer rows may be merged, into some of about so many


def _fold(state: dict, record: dict) -> None:
    """State: ``schemas``, a list of texts, and ``parts`` in order. A part is a folder with
    the rows of one upload or, if ``merged``, of so many; ``names`` are those that count, and
    ``origins`` has the folders that merged ones came in. ``stats`` are folders of
    summaries, each with the uploads (name, folder) that it has."""
    parts = state.setdefault("parts", [])
    schemas = state.setdefault("schemas", [])
    event = record["event"]
    if event in ("add", "remove"):
        for part in parts:
            if record["name"] in part["names"]:
                part["names"].remove(record["name"])
        state["parts"] = parts = [p for p in parts if p["names"]]
    if event == "add":
        if record["schema"] not in schemas:
            schemas.append(record["schema"])
        part = {"names": [record["name"]], "folder": record["folder"], "rows": record["rows"], "merged": 0}
        parts.append({**part, "schema": schemas.index(record["schema"])})
    if event == "merge":
        at = next(i for i, p in enumerate(parts) if p["folder"] == record["of"][0])
        kept = [p for p in parts if p["folder"] not in record["of"]]
        state["parts"] = [*kept[:at], record["part"], *kept[at:]]
    if event == "profiled":
        live = {pair for p in parts for pair in _identities(p)}
        stats = [s for s in state.get("stats", []) if live & {tuple(pair) for pair in s["of"]}]
        state["stats"] = [*stats, {k: record[k] for k in ("folder", "of", "columns")}]


def _identities(part: dict) -> list[tuple[str, str]]:
    """What tells an upload from others of its name: the folder it came in."""
    return [(n, part.get("origins", {}).get(n, part["folder"])) for n in part["names"]]


@dataclass(frozen=True)
class UploadTable:
    spark: SparkSession
    path: str
    declared: T.StructType | None = None
    merge_strategy: str = "append"

    def __post_init__(self):
        if self.merge_strategy not in STRATEGIES:
            raise ValueError(f"upload_merge_strategy must be one of {', '.join(STRATEGIES)}")

    # --- log

    def log(self) -> RecordLog:
        return RecordLog(self.spark, f"{self.path}/log", _fold)

    def parts(self) -> list[dict]:
        """The folders of live uploads, oldest first, each with its schema as text."""
        state = self.log().read()[1]
        return [{**p, "schema": state["schemas"][p["schema"]]} for p in state.get("parts", [])]

    def uploads(self) -> list[dict]:
        """Live uploads, oldest first; of one name the newest counts."""
        return [{"name": n, "folder": p["folder"], "schema": p["schema"]} for p in self.parts() for n in p["names"]]

    # --- ingest

    def upload(
        self,
        df: DataFrame,
        name: str,
        rename_on_conflict: bool = False,
        replace_on_conflict: bool = False,
        if_not_exists: bool = False,
        raise_on_fail: bool = True,
        remove_on_fail: bool = False,
    ) -> str | None:
        """Ingest a frame as one upload and give the name it got (None if it failed).

        A failed write never shows in the table; ``raise_on_fail=False`` swallows the error
        and ``remove_on_fail`` also removes the files it left. What to do about a name that
        is taken is asked before rows are written, and again by the commit: another writer
        may have taken it meanwhile.
        """
        if replace_on_conflict and rename_on_conflict:
            raise ValueError("rename_on_conflict excludes replace_on_conflict")

        def named(state: dict) -> str | None:
            """The name to take; None if the upload that has it shall stay."""
            taken = {n for p in state.get("parts", []) for n in p["names"]}
            if name not in taken or replace_on_conflict and not if_not_exists:
                return name
            if if_not_exists:
                return None
            if not rename_on_conflict:
                raise ValueError(f"{name} is taken by an upload; rename, replace or skip it")
            return next(n for i in range(1, len(taken) + 2) if (n := f"{name}_{i}") not in taken)

        log = self.log()
        mine = named(log.read()[1])
        if mine is None:
            return name
        at = self._folder(mine)
        try:
            rows = write_verified(df, at)
        except Exception:
            if remove_on_fail:
                remove_path(self.spark, at)
            if raise_on_fail:
                raise
            return None

        def decide(state: dict) -> dict | None:
            nonlocal mine, at
            now = named(state)
            if now not in (None, mine):
                moved = self._folder(now)
                rename_path(self.spark, at, moved)
                mine, at = now, moved
            return now and {"event": "add", "name": mine, "folder": at, "schema": df.schema.json(), "rows": rows}

        try:
            committed = log.commit(decide)
        except ValueError:
            remove_path(self.spark, at)
            raise
        if committed is None:
            remove_path(self.spark, at)
            return name
        return mine

    def _folder(self, name: str) -> str:
        return f"{self.path}/data/{UPLOAD_COLUMN}={_escaped(name)}/{uuid.uuid4().hex}"

    def remove(self, name: str) -> None:
        self.log().commit(lambda state: {"event": "remove", "name": name})

    def compact(self, small_rows: int = SMALL_ROWS, at_least: int = 2) -> int:
        """Merge small uploads that follow each other and have one schema; the number of
        folders that are live afterwards. Files of merged folders stay for readers and
        versions that know them."""
        for group in _small_groups(self.parts(), small_rows):
            if len(group) < at_least:
                continue
            folder = f"{self.path}/data/merged/{uuid.uuid4().hex}"
            # fewer rows than two small uploads may have, so one file
            rows = write_verified(_in_order(self.spark, group, f"{self.path}/data"), folder)
            names = [n for p in group for n in p["names"]]
            origins = dict(pair for p in group for pair in _identities(p))
            part = {"names": names, "folder": folder, "rows": rows, "merged": len(names), "origins": origins}

            def decide(state: dict, group=group, part=part) -> dict | None:
                live = {p["folder"]: p["names"] for p in state["parts"]}
                if any(live.get(p["folder"]) != p["names"] for p in group):
                    return None  # somebody replaced or removed one of them
                schema = state["schemas"].index(group[0]["schema"])
                return {"event": "merge", "of": [p["folder"] for p in group], "part": {**part, "schema": schema}}

            if self.log().commit(decide) is None:
                remove_path(self.spark, folder)
        return len(self.parts())

    # --- reads

    def read_upload(self, name: str) -> DataFrame:
        """One upload alone, with its own schema."""
        for p in self.parts():
            if name in p["names"]:
                schema = T.StructType.fromJson(json.loads(p["schema"]))
                return _scan(self.spark, [{**p, "names": [name]}], schema, None)
        raise LookupError(f"no upload named {name}")

    def read(self, lenient: bool = False, tagged: bool = False) -> DataFrame:
        """The merged table: all uploads, or the latest one under ``replace``.

        ``tagged`` adds the name of the upload each row came from.
        """
        return read_merged(self.spark, self._counted(), self.declared, lenient, f"{self.path}/data" if tagged else None)

    def _counted(self) -> list[dict]:
        """The parts that a read takes."""
        parts = self.parts()
        if self.merge_strategy == "replace":
            parts = [{**p, "names": p["names"][-1:]} for p in parts[-1:]]
        return parts

    # --- statistics

    def profile(self, lenient: bool = False) -> DataFrame:
        """The statistics of :func:`tablewright.operators.profile.profile` for the rows that
        ``read`` gives. Uploads that have no summary yet are read, all in one pass, and
        theirs are kept; those of all uploads are merged. A merge of small uploads keeps
        them. They are made anew where columns or types of the table have changed.
        """
        parts = self._counted()
        declared = self._columns(parts)
        columns = hashlib.md5(f"{declared.json()}{lenient}".encode()).hexdigest()
        missing = self._without(parts, self._profiled(columns))
        if missing:
            folder = f"{self.path}/stats/{uuid.uuid4().hex}"
            rows = read_merged(self.spark, missing, declared, lenient, f"{self.path}/data")
            summarize(rows, UPLOAD_COLUMN).write.parquet(folder)
            of = [pair for p in missing for pair in _identities(p)]
            self.log().commit(lambda state: {"event": "profiled", "folder": folder, "of": of, "columns": columns})
        profiled = self._profiled(columns)
        wanted = [(profiled[pair], pair[0]) for p in parts for pair in _identities(p)]
        return merge_summaries(self._summaries(wanted), declared)

    def _columns(self, parts: list[dict]) -> T.StructType:
        schemas = {p["schema"]: T.StructType.fromJson(json.loads(p["schema"])) for p in parts}
        return self.declared or union_schema(schemas.values())

    def _profiled(self, columns: str) -> dict[tuple[str, str], str]:
        """The folder with the summary of each upload (name, folder) that has one."""
        stats = self.log().read()[1].get("stats", [])
        return {tuple(pair): s["folder"] for s in stats if s["columns"] == columns for pair in s["of"]}

    @staticmethod
    def _without(parts: list[dict], profiled: dict) -> list[dict]:
        """Parts with the uploads alone that have no summary."""
        lacking = [{**p, "names": [n for n, came in _identities(p) if (n, came) not in profiled]} for p in parts]
        return [p for p in lacking if p["names"]]

    def _summaries(self, wanted: list[tuple[str, str]]) -> DataFrame:
        """The summaries of uploads, given by folder and name; an upload without rows has none."""
        schema = T.StructType([_TAG, *T._parse_datatype_string(SUMMARY).fields])
        if not wanted:
            return self.spark.createDataFrame([], schema)
        folders = sorted({folder for folder, _ in wanted})
        kept = self.spark.read.schema(schema).parquet(*folders)
        # a row for each live upload, as the log has it
        names = self.spark.createDataFrame([(f.rsplit("/", 1)[-1], n) for f, n in wanted], f"_of string, {UPLOAD_COLUMN} string")
        at = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        return kept.withColumn("_of", at).join(names, ["_of", UPLOAD_COLUMN]).drop("_of")


def _small_groups(parts: list[dict], small_rows: int) -> list[list[dict]]:
    """Small parts of one schema that follow each other, together not much over the limit."""
    groups: list[list[dict]] = []
    rows = 0
    for p in parts:
        last = groups[-1][-1] if groups else None
        fits = last and max(last["rows"], p["rows"]) < small_rows and last["schema"] == p["schema"] and rows < small_rows
        if fits:
            groups[-1].append(p)
        else:
            groups.append([p])
            rows = 0
        rows += p["rows"]
    return groups


_TAG = T.StructField(UPLOAD_COLUMN, T.StringType())


def _scan(spark: SparkSession, parts: list[dict], schema: T.StructType, tag_below: str | None, *places: Column) -> DataFrame:
    """Parts of one schema. Merged ones hold the names of their uploads, others have them
    as partition values in the folders below ``tag_below``. ``places``: metadata columns."""
    tagged = T.StructType([*schema.fields, _TAG])
    columns = [F.col(f"`{n}`") for n in (tagged if tag_below else schema).names]
    plain = [p["folder"] for p in parts if not p["merged"]]
    whole = [p["folder"] for p in parts if p["merged"] and p["merged"] == len(p["names"])]
    out = []
    if plain:
        reader = spark.read.schema(tagged if tag_below else schema)
        out.append((reader.option("basePath", tag_below) if tag_below else reader).parquet(*plain))
    if whole:
        out.append(spark.read.schema(tagged).parquet(*whole))
    for p in parts:
        if p["merged"] > len(p["names"]):
            # some of its uploads were replaced or removed since
            rows = spark.read.schema(tagged).parquet(p["folder"])
            out.append(rows.where(F.col(UPLOAD_COLUMN).isin(p["names"])))
    return reduce(DataFrame.unionByName, [rows.select(*columns, *places) for rows in out])


def _in_order(spark: SparkSession, parts: list[dict], tag_below: str) -> DataFrame:
    """The rows of parts with their tag, in the order of uploads, files and rows."""
    schema = T.StructType.fromJson(json.loads(parts[0]["schema"]))
    places = F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    order = [(n, i) for i, n in enumerate(n for p in parts for n in p["names"])]
    names = spark.createDataFrame(order, f"{UPLOAD_COLUMN} string, _nth int")
    rows = _scan(spark, parts, schema, tag_below, *places).join(F.broadcast(names), UPLOAD_COLUMN)
    return rows.repartition(1).sortWithinPartitions("_nth", "_file", "_row").select(*[F.col(f"`{n}`") for n in schema.names], UPLOAD_COLUMN)


def read_merged(
    spark: SparkSession,
    parts: list,
    declared: T.StructType | None = None,
    lenient: bool = False,
    tag_below: str | None = None,
) -> DataFrame:
    """Uploads, given by their folders and schemas, as one table.

    Uploads with one schema are one scan, so the plan grows with the number of schemas
    and not with the number of uploads. With ``tag_below`` the partition value in the
    folders below that path, the upload's name, becomes a column.
    """
    by_schema: dict[str, list] = {}
    for p in parts:
        by_schema.setdefault(p["schema"], []).append(p)
    schemas = {s: T.StructType.fromJson(json.loads(s)) for s in by_schema}
    declared = declared or union_schema(schemas.values())
    tag = [T.StructField(UPLOAD_COLUMN, T.StringType())] if tag_below else []
    declared = T.StructType([*declared.fields, *tag])
    if not parts:
        return spark.createDataFrame([], declared)
    scans = [_scan(spark, some, schemas[text], tag_below) for text, some in by_schema.items()]
    return merge_uploads(scans, declared, lenient)


def _escaped(name: str) -> str:
    """A name as a partition value: other ASCII characters than letters, digits, . - as %XX."""
    return re.sub(r"[\x00-\x7f]", lambda m: m[0] if m[0].isalnum() or m[0] in "._-" else f"%{ord(m[0]):02X}", name)
