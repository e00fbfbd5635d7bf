"""Datasets as released, immutable versions."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablewright.sources.log import RecordLog
from tablewright.sources.reader import sample_rows
from tablewright.sources.uploads import UploadTable, read_merged

_REFERENCE = re.compile(r"^(?P<name>[^:]+)(?P<rest>(?::[^:]+)*)$")
_TAG = re.compile(r"^(v\d+[._]\d+|current|next)$", re.IGNORECASE)


def normalize_tag(tag: str) -> str:
    """``1.0`` is ``v1.0``; ``current`` and ``next`` stay."""
    if tag in ("current", "next") or tag.lower().startswith("v"):
        return tag
    return f"v{tag}"


def parse_reference(reference: str) -> dict:
    """``name[:reference id][:version][:sample]`` in its parts."""
    m = _REFERENCE.match(reference)
    if not m:
        raise ValueError(f"not a dataset reference: {reference}")
    out = {"name": m["name"], "version": None, "sample": False, "reference_id": None}
    for part in m["rest"].split(":")[1:]:
        if part == "sample":
            out["sample"] = True
        elif _TAG.match(part):
            out["version"] = part
        else:
            out["reference_id"] = part
    return out


def _fold(state: dict, record: dict) -> None:
    """State: ``released`` versions in order, the folder of the ``open`` next one, and
    whether that was released with ``replace`` before it was taken back."""
    released = state.setdefault("released", [])
    if record["event"] == "open":
        state["open"], state["replace"] = record["folder"], False
    elif record["event"] == "release":
        released.append({k: record[k] for k in ("tag", "content", "folder", "replace")})
        state["open"] = None
    elif record["event"] == "unrelease":
        last = released.pop()
        state["open"], state["replace"] = last["folder"], last["replace"]


def _canonical(tag: str) -> str:
    return normalize_tag(tag).lower().replace("_", ".")


@dataclass(frozen=True)
class Dataset:
    """Versions of a group of tables below one folder.

    A version is a list of upload folders per table, fixed when it is released. Releasing
    and taking back change a log of small records and never copy or touch rows, whatever
    the size of the dataset.
    """

    spark: SparkSession
    path: str

    # --- log

    def log(self) -> RecordLog:
        return RecordLog(self.spark, f"{self.path}/log", _fold)

    def _state(self) -> dict:
        return {"released": [], "open": None, "replace": False, **self.log().read()[1]}

    def _content(self, version: dict) -> dict[str, list[dict]]:
        """The uploads of each table of a released version."""
        return self.log().get(version["content"])

    def versions(self) -> list[str]:
        """Released tags, oldest first."""
        return [v["tag"] for v in self._state()["released"]]

    # --- next version

    def create_next_version(self, if_not_exists: bool = False) -> None:
        """Open the next version; only one may be open."""

        def decide(state: dict) -> dict | None:
            if state.get("open") is None:
                return {"event": "open", "folder": f"next/{uuid.uuid4().hex}"}
            if not if_not_exists:
                raise ValueError("next version already exists; set if_not_exists to use it")
            return None

        self.log().commit(decide)

    def stage(self, table: str, declared: T.StructType | None = None) -> UploadTable:
        """The uploads waiting in the next version of a table."""
        open_folder = self._state()["open"]
        if open_folder is None:
            raise LookupError("no next version is open")
        return self._staged(open_folder, table, declared)

    def _staged(self, open_folder: str, table: str, declared: T.StructType | None = None) -> UploadTable:
        return UploadTable(self.spark, f"{self.path}/{open_folder}/{table}", declared)

    def _next(self, table: str, state: dict, replace: bool) -> list[dict]:
        """The uploads of a table in the next version: the current ones and the staged ones."""
        released = state["released"]
        current = [] if replace or not released else self._content(released[-1]).get(table, [])
        kept = ("folder", "schema", "names", "merged")
        return current + [{k: p[k] for k in kept} for p in self._staged(state["open"], table).parts()]

    def release(self, tag: str, tables: list[str], notes: str = "", replace: bool | None = None) -> str:
        """Make the next version the current one.

        ``tables`` get their staged uploads, after the current rows or (``replace``) in
        place of them; other tables stay as they are. A version that was taken back is
        released as it was before unless ``replace`` says otherwise.
        """
        tag = _canonical(tag)

        def decide(state: dict) -> dict:
            state = {"released": [], "open": None, "replace": False, **state}
            as_before = state["replace"] if replace is None else replace
            if state["open"] is None:
                raise LookupError("no next version is open")
            if tag in ("current", "next") or tag in (v["tag"] for v in state["released"]):
                raise ValueError(f"version {tag} is already released")
            content = self._content(state["released"][-1]) if state["released"] else {}
            content = content | {t: self._next(t, state, as_before) for t in tables}
            # what a version holds is a file of its own, so that records stay small
            name = f"content-{uuid.uuid4().hex}.json"
            self.log().put(name, content)
            return {"event": "release", "tag": tag, "content": name, "folder": state["open"], "replace": as_before, "notes": notes}

        self.log().commit(decide)
        return tag

    def unrelease(self) -> str:
        """Take the current version back; its uploads are again the open next version."""

        def decide(state: dict) -> dict:
            if not state.get("released"):
                raise LookupError("no version is released")
            if state.get("open") is not None:
                raise ValueError("close the next version first")
            return {"event": "unrelease", "tag": state["released"][-1]["tag"]}

        return self.log().commit(decide)["tag"]

    # --- reads

    def read(
        self,
        table: str,
        version: str = "current",
        declared: T.StructType | None = None,
        sample_keys: list[str] | None = None,
        sample_percent: float = 1.0,
    ) -> DataFrame:
        """A table at a version; with ``sample_keys`` its repeatable sample."""
        state, tag = self._state(), _canonical(version)
        if tag == "next":
            if state["open"] is None:
                raise LookupError("no next version is open")
            uploads = self._next(table, state, state["replace"])
        else:
            found = [v for v in state["released"] if tag in ("current", v["tag"])][-1:]
            uploads = self._content(found[0]).get(table) if found else None
        if not uploads:
            raise LookupError(f"no table {table} at version {version}")
        df = read_merged(self.spark, uploads, declared)
        return sample_rows(df, sample_keys, sample_percent) if sample_keys else df
