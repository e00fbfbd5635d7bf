"""Records of delimited text with quoted line breaks, read by byte ranges.

Whether a line break ends a record depends on all quotes before it in the file. So each
range is first scanned for what state it would end in if it began outside quotes, and if it
began inside. These answers are composed along each file, and then every range knows its
state and is read on its own: it gives the records that begin in it. A file of any size is
as many tasks as it has ranges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tablewright.session import materialize
from tablewright.sources.files import open_filesystem

RANGE_BYTES = 1 << 25
BATCH_ROWS, BATCH_BYTES = 4096, 1 << 23
BOM = b"\xef\xbb\xbf"


@dataclass(frozen=True)
class Quotes:
    """A dialect, and how far a piece of text is inside quotes. A quote opens a field only
    where the field begins; elsewhere it is text."""

    delimiter: str
    quote: str
    escape: str

    @cached_property
    def marks(self) -> bytes:
        """Bytes whose meaning depends on what follows: no range ends behind one."""
        return (self.quote + (self.escape or self.quote)).encode()

    @cached_property
    def lead(self) -> int:
        """Bytes before a place that say whether a field begins there."""
        return len(self.delimiter.encode())

    @cached_property
    def _patterns(self) -> tuple[re.Pattern, re.Pattern]:
        q, e, d = (re.escape(x.encode()) for x in (self.quote, self.escape or self.quote, self.delimiter))
        body = rb"(?:[^%b]++|%b%b)*+(%b?)" % (q, q, q, q) if q == e else rb"(?:[^%b%b]++|%b.)*+(%b?)" % (q, e, e, q)
        return re.compile(body, re.DOTALL), re.compile(rb"(?:(?<=%b)|(?<=\n)|(?<=\r))%b%b" % (d, q, body), re.DOTALL)

    def spans(self, data: bytes, start: int, inside: bool) -> tuple[np.ndarray, bool]:
        """The quoted parts from ``start`` on, [part, 2], and whether the last is still open."""
        ends = [False]
        found = np.fromiter(self._spans(data, start, inside, ends), dtype=np.dtype((np.int64, 2)))
        return found, ends[0]

    def _spans(self, data: bytes, start: int, inside: bool, ends: list[bool]) -> Iterator[tuple[int, int]]:
        if not self.quote:
            return
        rest, field = self._patterns
        if inside:
            m = rest.match(data, start)
            ends[0] = not m[1]
            yield start, m.end()
            if not m[1]:
                return
            start = m.end()
        for m in field.finditer(data, start):
            ends[0] = not m[1]
            yield m.span()

    def open_after(self, data: bytes, start: int, inside: bool) -> bool:
        """Whether the end is inside quotes; no parts are kept."""
        ends = [False]
        for _ in self._spans(data, start, inside, ends):
            pass
        return ends[0]

    def breaks(self, data: bytes, start: int, inside: bool) -> tuple[np.ndarray, bool]:
        """Places of the line breaks that end records, and whether the end is inside."""
        edges, open_end = self.spans(data, start, inside)
        at = np.flatnonzero(np.frombuffer(data, np.uint8)[start:] == 10) + start
        if len(edges) and len(at):
            k = np.searchsorted(edges[:, 0], at, "right") - 1
            at = at[(k < 0) | (at >= edges[np.maximum(k, 0), 1])]
        return at, open_end


def _begin(f, at: int, size: int, quotes: Quotes) -> int:
    """The first place from ``at`` on that is not behind a quote or escape."""
    if at <= 0 or not quotes.quote:
        return min(max(at, 0), size)
    step = 64
    while at < size:
        f.seek(at - 1)
        piece = f.read(step)
        for k, c in enumerate(piece):
            if c not in quotes.marks:
                return min(at + k, size)
        at += len(piece)
        step *= 2
    return size


def _piece(f, begin: int, end: int, quotes: Quotes) -> tuple[bytes, int]:
    """The bytes of a range with those before it; how many these are. A file is taken to
    begin behind a line break."""
    lead = max(quotes.lead, 1)
    f.seek(max(begin - lead, 0))
    data = f.read(end - max(begin - lead, 0))
    if begin >= lead:
        return data, lead
    if begin == 0 and data.startswith(BOM):
        data = data[len(BOM) :]
    return b"\n" * lead + data, lead + begin


def ranges(spark: SparkSession, path: str | list[str], quotes: Quotes, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, range, begin, end, inside): the byte ranges of all files, each with the state
    that it begins in. Tasks read every byte once."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("size"))
    range_bytes = max(range_bytes, 16)
    last = F.greatest(F.ceil(F.col("size") / range_bytes).cast("int") - 1, F.lit(0))
    cut = materialize(files.select("file", "size", F.explode(F.sequence(F.lit(0), last)).alias("range")), "ranges")
    schema = "file string, range int, begin bigint, end bigint, if_outside boolean, if_inside boolean"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, name = open_filesystem(row["file"])
                with system.open_input_file(name) as f:
                    begin, end = (_begin(f, (row["range"] + k) * range_bytes, row["size"], quotes) for k in (0, 1))
                    data, start = _piece(f, begin, end, quotes)
                states = [quotes.open_after(data, start, inside) for inside in (False, True)]
                values = (row["file"], row["range"], begin, end, *states)
                yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(("file", "range", "begin", "end", "if_outside", "if_inside"), values)}, schema=target)

    target = pa.schema([("file", pa.string()), ("range", pa.int32()), ("begin", pa.int64()), ("end", pa.int64()), ("if_outside", pa.bool_()), ("if_inside", pa.bool_())])
    scanned = materialize(cut.repartition(_tasks(cut)).mapInArrow(scan, schema), "ranges")
    # A range keeps the state, turns it, or sets it. What a range begins in: what the last
    # range before it that sets the state says, turned as often as ranges since then do.
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sets = F.col("if_outside") == F.col("if_inside")
    turns = F.sum(F.when(~sets & F.col("if_outside"), 1).otherwise(0)).over(before)
    counted = scanned.withColumn("_turns", F.coalesce(turns, F.lit(0)))
    here = F.col("_turns")
    known = F.last(F.when(sets, F.struct(F.col("if_outside").alias("state"), here.alias("turns"))), ignorenulls=True).over(before)
    known = F.coalesce(known, F.struct(F.lit(False).alias("state"), F.lit(0).cast("bigint").alias("turns")))
    inside = known["state"] != ((here - known["turns"]) % 2 == 1)
    return materialize(counted.select("file", "range", "begin", "end", inside.alias("inside")), "ranges")


def _tasks(rows: DataFrame) -> int:
    return max(1, min(rows.count(), 8 * rows.sparkSession.sparkContext.defaultParallelism))


def records(found: DataFrame, quotes: Quotes, skip_first: bool) -> DataFrame:
    """(value): every record of the files whose ranges are given, as text without its line
    end; empty lines are none. ``skip_first`` leaves out the first record of each file.
    Broken UTF-8 becomes a replacement character."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, name = open_filesystem(row["file"])
                with system.open_input_file(name) as f:
                    yield from _batches(_records(f, row, quotes, skip_first))

    return found.repartition(_tasks(found)).mapInArrow(read, "value string")


def _records(f, row: dict, quotes: Quotes, skip_first: bool) -> Iterator[bytes]:
    begin, end = row["begin"], row["end"]
    if begin >= end:
        return
    data, start = _piece(f, begin, end, quotes)
    ends, _ = quotes.breaks(data, start, row["inside"])
    at = start
    if begin > 0 and (row["inside"] or data[start - 1] != 10):
        if not len(ends):
            return
        at, ends = int(ends[0]) + 1, ends[1:]
    elif begin == 0:
        at = max(quotes.lead, 1)
    skip = skip_first and begin == 0
    for e in ends.tolist():
        line, at = data[at:e], e + 1
        if line.rstrip(b"\r"):
            if not skip:
                yield line.removesuffix(b"\r")
            skip = False
    if at < len(data):
        f.seek(end)
        line = _rest(f, data[at:], quotes)
        if line.rstrip(b"\r") and not skip:
            yield line.removesuffix(b"\r")


def _rest(f, line: bytes, quotes: Quotes) -> bytes:
    """A record that begins with ``line`` and goes on at the file's place."""
    lead, step = b"\n" * max(quotes.lead, 1), 1 << 16
    while True:
        ends, _ = quotes.breaks(lead + line, len(lead), False)
        if len(ends):
            return line[: int(ends[0]) - len(lead)]
        more = f.read(step)
        if not more:
            return line
        line += more
        step = min(2 * step, RANGE_BYTES)


def _batches(lines: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    some, size = [], 0
    for line in lines:
        some.append(line.decode("utf-8", "replace"))
        size += len(line)
        if len(some) == BATCH_ROWS or size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], ["value"])
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], ["value"])


def first_record(f, quotes: Quotes) -> str:
    """The first record of a file just opened, of any length."""
    line = _rest(f, f.read(len(BOM)).removeprefix(BOM), quotes)
    return line.decode("utf-8", "replace").rstrip("\r")
