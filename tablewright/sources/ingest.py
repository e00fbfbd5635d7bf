"""Uploads straight from files: name, type, dialect and column types follow from them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import path_exists
from tablewright.sources import delimited, quoted
from tablewright.sources.files import open_filesystem
from tablewright.sources.uploads import UploadTable
from tablewright.types import field

# What endings of names say.
DELIMITERS = {"csv": ",", "tsv": "\t", "tab": "\t", "psv": "|"}
OTHERS = {"txt": "delimited", "parquet": "parquet", "orc": "orc", "json": "json", "jsonl": "json", "ndjson": "json"}
# Logical types that texts are tried as, the narrowest first, and how their
# values look. Numbers with leading zeros are codes, which stay text.
TRIED = {
    "integer": r"^[+-]?(0|[1-9][0-9]{0,18})$",
    "float": r"^[+-]?(0|[1-9][0-9]*)?(\.[0-9]*)?([eE][+-]?[0-9]+)?$",
    "boolean": r"^(?i)(true|false)$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "dateTime": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?$",
}


def file_type(path: str) -> tuple[str, str | None]:
    """(type, delimiter) by the ending of a name, before that of a compression."""
    base = delimited._COMPRESSED.sub("", path.rstrip("/").rsplit("/", 1)[-1])
    ending = base.rsplit(".", 1)[-1].lower() if "." in base else ""
    if ending in DELIMITERS:
        return "delimited", DELIMITERS[ending]
    if ending in OTHERS:
        return OTHERS[ending], None
    raise ValueError(f"the name {base} does not say what type it is; give a type")


def sniffed_delimiter(spark: SparkSession, path: str, quote: str = '"') -> str:
    """The one of , ; | and tab that the first record has most often outside quotes."""
    first = spark.read.format("binaryFile").load(path).where("length > 0").select("path").first()
    if first is None:
        return ","
    system, name = open_filesystem(first["path"])
    with system.open_input_stream(name, compression="detect" if delimited._COMPRESSED.search(name) else None) as f:
        head = quoted.first_record(f, quoted.Quotes(",", quote, quote))
    bare = re.sub(rf"{re.escape(quote)}[^{re.escape(quote)}]*{re.escape(quote)}", "", head) if quote else head
    return max(",\t;|", key=bare.count)


def typed(df: DataFrame) -> DataFrame:
    """Text columns as the narrowest logical type that all their values have, found in one
    pass; columns without a value, and those with a type already, stay as they are."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not names:
        return df
    fits = []
    for i, n in enumerate(names):
        value = F.col(f"`{n}`")
        fits.append(F.count(value).alias(f"n_{i}"))
        for t, pattern in TRIED.items():
            cast = F.when(value.rlike(pattern), value.try_cast(field(n, t).dataType))
            fits.append(F.count(cast).alias(f"{t}_{i}"))
    counts = df.agg(*fits).first()
    chosen = {}
    for i, n in enumerate(names):
        found = [t for t in TRIED if counts[f"{t}_{i}"] == counts[f"n_{i}"] > 0]
        if found:
            chosen[n] = field(n, found[0]).dataType
    return df.select(*[F.col(f"`{c}`").try_cast(chosen[c]).alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns])


def read_files(
    spark: SparkSession,
    path: str,
    type: str | None = None,
    delimiter: str | None = None,
    schema: T.StructType | None = None,
    quote_character: str = '"',
    has_quoted_newlines: bool | None = None,
    **dialect,
) -> DataFrame:
    """A file, or a folder of files, of a type that its name gives if ``type`` does not.

    Delimited text without a given ``delimiter`` is looked at; quoted line breaks are
    allowed unless excluded, as ranges are read all the same. Without ``schema``, columns
    get the types of their values.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"nothing at {path}")
    told = (type, None) if type else file_type(path)
    kind, known = ("delimited", DELIMITERS[told[0]]) if told[0] in DELIMITERS else told
    kind = OTHERS.get(kind, kind)
    if kind == "delimited":
        delimiter = delimiter or known or sniffed_delimiter(spark, path, quote_character)
        quotes = bool(quote_character) if has_quoted_newlines is None else has_quoted_newlines
        df = delimited.read_delimited(spark, path, schema, delimiter, quote_character=quote_character, has_quoted_newlines=quotes, **dialect)
        return df if schema is not None else typed(df)
    if dialect or delimiter:
        raise ValueError(f"a dialect says nothing of {kind} files")
    if kind not in ("parquet", "orc", "json"):
        raise ValueError(f"unknown type of files: {kind}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(kind).load(path)


def upload_file(
    table: UploadTable,
    path: str,
    name: str | None = None,
    conflicts: dict | None = None,
    **reading,
) -> str | None:
    """Ingest a file as an upload, named as the file unless told otherwise. ``conflicts``
    are options of :meth:`UploadTable.upload`, ``reading`` those of :func:`read_files`."""
    df = read_files(table.spark, path, **reading)
    return table.upload(df, name or path.rstrip("/").rsplit("/", 1)[-1], **(conflicts or {}))
