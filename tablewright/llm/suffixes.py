"""Exact substring deduplication by column-wise construction over a collection.

The construction inserts one symbol of every string a round, from the last column to the
first, and keeps the strings in the order of what has been inserted, with the common
prefixes of neighbours: a stable sort by the new symbol, and the least common prefix of
what lay between two neighbours before, plus one. The sorted columns of symbols in front
are the collection's Burrows-Wheeler transform. Neighbours with 50 symbols in common start
with the same 50 bytes.

Whole documents would take as many rounds as the longest has bytes. Therefore a document is
first cut where equal strings are cut alike: each window of 50 bytes belongs to the 16
bytes in it with the least hash, its anchor. Windows of one anchor make a fragment, aligned
at the anchor, so that equal windows start in the same column of fragments with the same
anchor, and 84 rounds are enough. Fragments are written, shuffled and read by anchor as
sequential files, in blocks of bounded size. Anchors that occur once are left out by a
first pass. Anchors of very many fragments, which would be large groups, are taken apart
into their windows and grouped by window instead, which gives the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.llm.common import map_rows, register, table
from tablewright.llm.hashing import Bits, mixed
from tablewright.session import materialize

SPAN = 50  # bytes of a repeated string
GRAM = 16  # bytes of an anchor
REACH = SPAN - GRAM  # an anchor starts at most so far inside its window
COLUMNS = SPAN + REACH
NONE = 256  # the symbol beyond a fragment's ends: never equal
HOT = 20_000  # fragments of an anchor that are still one group
BLOCK = 40_000  # fragments inserted together, unless one anchor has more
BITS = 26  # filters of 8 MB

LAST = (1 << 63) - 1  # stands for a null id: behind all others


def fragments(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, windows, offset of the anchor in the first window) for
    each fragment of a text of at least SPAN bytes."""
    b = np.frombuffer(data, np.uint8).astype(np.uint64)
    w = b[:-1] | b[1:] << np.uint64(8)
    w = w[:-2] | w[2:] << np.uint64(16)
    w = w[:-4] | w[4:] << np.uint64(32)
    least = mixed(w[:-8] * np.uint64(0x9E3779B97F4A7C15) + mixed(w[8:]))
    where = np.arange(len(least), dtype=np.int32)
    width, step = 1, 1
    while width <= REACH:  # the leftmost of equals, over windows of REACH + 1 grams
        step = min(width, REACH + 1 - width)
        left = least[:-step] <= least[step:]
        where = np.where(left, where[:-step], where[step:])
        least = np.where(left, least[:-step], least[step:])
        width += step
    start = np.concatenate([[0], np.flatnonzero(np.diff(where)) + 1])
    count = np.diff(np.append(start, len(where)))
    return least[start], start, count, where[start] - start


def collection(strings: list[bytes], offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Column-wise construction over fragments aligned at their anchors.

    Yields (r, order, common) for each distance r of a window's start before the anchor:
    the fragments in the order of what starts there, and how many symbols each has in
    common with the one before it, SPAN at most."""
    n = len(strings)
    symbols = np.full((COLUMNS, n), NONE, dtype=np.uint16)
    sizes = np.array([len(s) for s in strings])
    row = np.repeat(np.arange(n), sizes)
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[inside + REACH - np.repeat(offsets, sizes), row] = np.frombuffer(b"".join(strings), np.uint8)
    order, common = np.arange(n), np.zeros(n, dtype=np.int16)
    for column in range(COLUMNS - 1, -1, -1):
        new = symbols[column][order]
        moved = np.argsort(new, kind="stable")
        new = new[moved]
        between = np.minimum.reduceat(np.append(common[1:], np.int16(0)), moved) if n else common
        same = (new[1:] == new[:-1]) & (new[1:] != NONE)
        common = np.zeros(n, dtype=np.int16)
        common[1:] = np.where(same, np.minimum(between[:-1] + 1, SPAN), 0)
        order = order[moved]
        if column <= REACH:
            yield REACH - column, order, common


def repeated_windows(strings: list[bytes], offsets: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """[fragment, r]: whether the window starting r bytes before the fragment's anchor
    also starts in a fragment of a smaller document."""
    flags = np.zeros((len(strings), REACH + 1), dtype=bool)
    for r, order, common in collection(strings, offsets):
        heads = np.flatnonzero(common < SPAN)
        if len(heads) == len(order):
            continue
        own = docs[order]
        least = np.repeat(np.minimum.reduceat(own, heads), np.diff(np.append(heads, len(order))))
        flags[order[own > least], r] = True
    return flags


def _intervals(flags: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fragment, start, end) of the bytes that flagged windows cover, one run each."""
    edge = np.zeros((len(flags), REACH + 3), dtype=np.int8)
    edge[:, 1:-1] = flags[:, ::-1]  # by rising starts
    change = np.diff(edge, axis=1)
    which, first = np.nonzero(change == 1)
    last = np.nonzero(change == -1)[1] - 1
    at = anchors[which] - REACH
    return which, at + first, at + last + SPAN


def _keyed(docs: DataFrame) -> DataFrame:
    """Adds (order_id, doc_key): the id with null last, and a hash of id and text."""
    return docs.withColumn("order_id", F.coalesce("doc_id", F.lit(LAST))).withColumn("doc_key", F.xxhash64("order_id", F.xxhash64("text")))


def _anchor_counts(rows: DataFrame, first_ones: Bits) -> DataFrame:
    """(anchor, fragments, docs) over the documents that stand for their copies."""
    shared = rows.sparkSession.sparkContext.broadcast(first_ones)

    def make():
        wanted = shared.value

        def step(keys, values):
            take = wanted.has(np.array(keys, dtype=np.int64).view(np.uint64)) if keys else []
            found = [fragments(d)[0] for v, t in zip(values, take, strict=True) if t and len(d := v.encode("utf-8", "surrogatepass")) >= SPAN]
            if not found:
                return [[], [], []]
            anchors, counts = np.unique(np.concatenate(found), return_counts=True)
            each, docs = np.unique(np.concatenate([np.unique(f) for f in found]), return_counts=True)
            return [anchors.view(np.int64), counts, docs]

        return step

    made = map_rows(rows.select("doc_key", "text"), make, "anchor long, fragments long, docs long")
    return made.groupBy("anchor").agg(F.sum("fragments").alias("fragments"), F.sum("docs").alias("docs"))


FRAGMENT = "anchor long, order_id long, doc_key long, start long, off int, bytes binary"


def _cut(rows: DataFrame, first_ones: Bits, wanted: Bits) -> DataFrame:
    """The fragments whose anchors are wanted, of documents that stand for their copies."""
    context = rows.sparkSession.sparkContext
    firsts, anchors = context.broadcast(first_ones), context.broadcast(wanted)

    def make():
        def step(ids, keys, values):
            out: list[list] = [[] for _ in range(6)]
            take = firsts.value.has(np.array(keys, dtype=np.int64).view(np.uint64)) if keys else []
            for order_id, key, value, t in zip(ids, keys, values, take, strict=True):
                data = value.encode("utf-8", "surrogatepass")
                if not t or len(data) < SPAN:
                    continue
                anchor, start, count, off = fragments(data)
                good = np.flatnonzero(anchors.value.has(anchor))
                begin = start[good].tolist()
                end = (start[good] + count[good] + SPAN - 1).tolist()
                n = len(begin)
                columns = (anchor[good].view(np.int64).tolist(), [order_id] * n, [key] * n, begin, off[good].tolist(), [data[a:b] for a, b in zip(begin, end, strict=True)])
                for column, v in zip(out, columns, strict=True):
                    column += v
            return out

        return step

    return map_rows(rows.select("order_id", "doc_key", "text"), make, FRAGMENT)


COVER = "order_id long, doc_key long, start long, end long"


def _covered(cut: DataFrame) -> DataFrame:
    """COVER rows from FRAGMENT rows: whole anchors by task, block after block."""
    target = to_arrow_schema(T._parse_datatype_string(COVER))

    def judge(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        offsets = rows["off"].to_numpy().astype(np.int64)
        flags = repeated_windows(rows["bytes"].to_pylist(), offsets, rows["order_id"].to_numpy())
        which, start, end = _intervals(flags, rows["start"].to_numpy() + offsets)
        ids = [rows[c].to_numpy()[which] for c in ("order_id", "doc_key")]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (*ids, start, end)], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < BLOCK:
                continue
            rows = pa.Table.from_batches(held)
            anchors = rows["anchor"].to_numpy()
            cut_at = int(np.searchsorted(anchors, anchors[-1]))  # the last anchor may go on
            if cut_at:
                yield from judge(rows.slice(0, cut_at))
                held = rows.slice(cut_at).to_batches()
        if held:
            yield from judge(pa.Table.from_batches(held))

    return cut.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, COVER)


def _covered_by_window(cut: DataFrame) -> DataFrame:
    """COVER rows from FRAGMENT rows of anchors with very many: grouped by window."""
    last = F.length("bytes") - F.lit(SPAN)
    windows = cut.select("order_id", "doc_key", "start", F.explode(F.sequence(F.lit(0), last)).alias("i"), "bytes")
    windows = windows.select("order_id", "doc_key", (F.col("start") + F.col("i")).alias("start"), F.unhex(F.sha2(F.substring("bytes", F.col("i") + 1, F.lit(SPAN)), 256)).alias("window"))
    windows = materialize(windows, "windows")
    least = windows.groupBy("window").agg(F.min("order_id").alias("least"), F.max("order_id").alias("most")).filter("least < most").drop("most")
    return windows.join(least, "window").filter("order_id > least").select("order_id", "doc_key", "start", (F.col("start") + SPAN).alias("end"))


def deduplicated(docs: DataFrame, keep_text: bool = True, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) for each row of ``docs``:
    what remains of its text, as UTF-8 bytes, without every byte that is covered by a
    SPAN-byte string which also starts in a document with a smaller id.

    Null text counts as empty. A null id is larger than all others; documents with null
    ids do not lose bytes to each other, nor do rows with the same id. Repeated rows each
    give a row. An empty table gives no rows. Further columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = _keyed(source)
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    base = materialize(rows.select("doc_id", "order_id", "doc_key", F.octet_length("text").cast("long").alias("n_bytes"), digest), "texts")
    firsts = base.filter(F.col("n_bytes") >= SPAN).groupBy("digest").agg(F.min("order_id").alias("first_id"))
    base = materialize(base.join(firsts, "digest", "left"), "texts")
    first_ones = Bits.of(base.filter("order_id = first_id"), "doc_key", BITS)

    counts = _anchor_counts(rows, first_ones).filter("docs > 1")
    counts = materialize(counts, "anchors")
    covers = _covered(_cut(rows, first_ones, Bits.of(counts.filter(F.col("fragments") <= hot), "anchor", BITS)))
    many = counts.filter(F.col("fragments") > hot)
    if not many.isEmpty():
        large = _cut(rows, first_ones, Bits.of(many, "anchor", BITS)).join(many.select("anchor"), "anchor", "left_semi")
        covers = covers.union(_covered_by_window(large))
    span = F.struct("start", "end")
    # the covered runs of one document
    spans = covers.groupBy("order_id", "doc_key").agg(F.array_sort(F.collect_set(span)).alias("spans"))
    spans = materialize(spans, "spans")
    return _removed(rows, base, spans, keep_text)


def _removed(rows: DataFrame, base: DataFrame, spans: DataFrame, keep_text: bool) -> DataFrame:
    """Only texts that lose bytes are shuffled, to meet their spans."""
    shared = rows.sparkSession.sparkContext.broadcast(Bits.of(spans, "doc_key", BITS))

    def take():
        wanted = shared.value

        def step(ids, keys, values):
            good = np.flatnonzero(wanted.has(np.array(keys, dtype=np.int64).view(np.uint64))) if keys else []
            return [[column[i] for i in good] for column in (ids, keys, values)]

        return step

    texts = map_rows(rows.select("order_id", "doc_key", "text"), take, "order_id long, doc_key long, text string").dropDuplicates(["order_id", "doc_key"])
    hit = texts.join(spans, ["order_id", "doc_key"])

    def make():
        def step(ids, keys, values, found):
            out: list[list] = [ids, keys, [], [], [], []]
            for value, runs in zip(values, found, strict=True):
                data, kept, at, n_spans = value.encode("utf-8", "surrogatepass"), [], 0, 0
                for run in runs:
                    if run["start"] > at or (not n_spans and run["start"] == at):
                        kept.append(data[at : run["start"]])
                        n_spans += 1
                    at = max(at, run["end"])
                kept = b"".join([*kept, data[at:]])
                for column, v in zip(out[2:], (len(data) - len(kept), n_spans, hashlib.sha256(kept).digest(), kept if keep_text else None), strict=True):
                    column.append(v)
            return out

        return step

    schema = "order_id long, doc_key long, r_removed long, r_spans long, r_digest binary, r_kept binary"
    changed = map_rows(hit.select("order_id", "doc_key", "text", "spans"), make, schema)
    copy = F.coalesce(F.col("order_id") > F.col("first_id"), F.lit(False))
    out = base.join(changed, ["order_id", "doc_key"], "left")
    columns = [
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("r_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("r_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(b""), 256)).otherwise(F.lower(F.hex(F.coalesce("r_digest", "digest")))).alias("kept_sha256"),
    ]
    if keep_text:
        whole = rows.select("order_id", "doc_key", F.col("text").cast("binary").alias("_whole")).dropDuplicates(["order_id", "doc_key"])
        out = out.join(whole, ["order_id", "doc_key"], "left")
        columns.append(F.when(copy, F.lit(b"")).otherwise(F.coalesce("r_kept", "_whole")).alias("kept"))
    return out.select(*columns)


@register("op4_column_bwt")
def op4_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"), keep_text=False)
