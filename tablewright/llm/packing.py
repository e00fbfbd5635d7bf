"""Best-fit decreasing packing of token sequences.

Pieces of one length are interchangeable, so the packing is decided on the counts of the
lengths (no more of them than a sequence has tokens) and then read off by each piece's
rank among the pieces of its length. The result is that of placing the pieces one by one,
longest first, each into the tightest open sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tablewright.llm.common import map_rows, register, table, texts
from tablewright.llm.tokens import byte_bpe_encoder
from tablewright.session import materialize

CAPACITY = 2048
BLOCKS = 1024


class Room:
    """Segment tree over remaining capacities: the least that holds an open sequence and
    is at least a given length, in time logarithmic in the capacity.

    A leaf has the open sequences with so much room left, as ranges of their numbers."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.filled = [False] * (2 * self.leaves)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, room: int, on: bool) -> None:
        node = room + self.leaves
        self.filled[node] = on
        while node > 1:
            node //= 2
            self.filled[node] = self.filled[2 * node] or self.filled[2 * node + 1]

    def push(self, room: int, first: int, n: int) -> None:
        if n:
            self.ranges[room].append((first, n))
            self._mark(room, True)

    def pop(self, room: int) -> tuple[int, int]:
        out = self.ranges[room].pop()
        if not self.ranges[room]:
            self._mark(room, False)
        return out

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length`` that an open sequence has."""
        node = length + self.leaves
        if self.filled[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.filled[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.filled[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Place ``counts[length]`` pieces of each length.

    Returns (length, first rank, pieces, first sequence, pieces in each, offset): pieces
    of that length, from that rank on, go into consecutive sequences, so many into each,
    one behind the other from that offset. A sequence that takes a piece stays the
    tightest for the next piece of the same length while one fits, so whole ranges of
    equal sequences are filled in one step.
    """
    room, steps, opened = Room(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            space = room.tightest(length)
            if space is None:
                n = -(-left // (capacity // length))
                room.push(capacity, opened, n)
                opened, space = opened + n, capacity
            first, n = room.pop(space)
            each = space // length
            full = min(n, left // each)
            rest = left - full * each if full < n else 0
            steps.append((length, rank, full * each + rest, first, each, capacity - space))
            room.push(space, first + full + bool(rest), n - full - bool(rest))
            if rest:
                room.push(space - rest * length, first + full, 1)
            room.push(space - each * length, first, full)
            rank, left = rank + full * each + rest, left - full * each - rest
    return steps


def pieces(
    docs: DataFrame,
    encoder: Callable[[], Callable[[str], bytes]] = byte_bpe_encoder,
    capacity: int = CAPACITY,
    end_id: int = 0,
    keep_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and ``end_id``,
    cut from the end into pieces of ``capacity`` if longer, so that the first may be shorter.

    ``encoder`` makes, in each task, a function from text to ids (little-endian unsigned
    32 bit). Null text counts as empty: one piece with ``end_id`` alone.
    """
    end = int(end_id).to_bytes(4, "little")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if keep_ids:
        schema += ", ids binary"

    def make():
        encode = encoder()

        def step(doc_ids, values):
            out: list[list] = [[] for _ in range(5 + keep_ids)]
            for doc_id, text in zip(doc_ids, values, strict=True):
                ids = encode(text or "") + end
                total = len(ids) // 4
                cuts = [0, *range(total % capacity or capacity, total + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    part = ids[4 * a : 4 * b]
                    for column, v in zip(out, (doc_id, k, a, b - a, zlib.crc32(part), part), strict=False):
                        column.append(v)
            return out

        return step

    return map_rows(texts(docs, id_col, text_col), make, schema)


def pack(cut: DataFrame, capacity: int = CAPACITY, blocks: int = BLOCKS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the rows of :func:`pieces`.

    A length may hold a third of all pieces, so ranks are taken inside hash blocks of the
    ids and shifted by the counts of the blocks before. The driver sees one count for each
    length; the steps sent to the tasks are bounded by the capacity, not by the rows.
    """
    schema = [f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields]
    blocked = cut.withColumn("_block", F.pmod(F.xxhash64("doc_id", "ids_crc32"), F.lit(blocks)).cast("int"))
    counts = blocked.groupBy("length", "_block").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(
        counts.select("length", "_block", "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")),
        "lengths",
    )
    totals = {r[0]: r[1] for r in before.groupBy("length").agg(F.sum("_n")).collect()}
    steps = np.array(best_fit_decreasing(totals, capacity) or np.zeros((0, 6)), dtype=np.int64).reshape(-1, 6)
    order = Window.partitionBy("length", "_block").orderBy("doc_id", "ids_crc32", "piece", "start")
    ranked = (
        blocked.withColumn("_rank", F.row_number().over(order).cast("long") - 1)
        .join(before.drop("_n"), ["length", "_block"])
        .select(*cut.columns, (F.col("_rank") + F.col("_before")).alias("_rank"))
    )
    at_length, at_rank = cut.columns.index("length"), len(cut.columns)
    # steps in order of (length, rank); both fit one integer
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    keys = (steps[:, 0] << 44) + steps[:, 1]

    def make():
        def step(*columns):
            length = np.array(columns[at_length], dtype=np.int64)
            rank = np.array(columns[at_rank], dtype=np.int64)
            s = steps[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
            nth = rank - s[:, 1]
            return [*columns[:at_rank], s[:, 3] + nth // s[:, 4], s[:, 5] + nth % s[:, 4] * length]

        return step

    return map_rows(ranked, make, ", ".join([*schema, "sequence_id long", "offset long"]))


def packed(docs: DataFrame, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack ``docs``: one row per piece, with its sequence and offset.

    Null text is empty text. Repeated rows are packed as often as they occur. Null ids are
    kept. An empty table gives no rows. Further columns are not read.
    """
    return pack(materialize(pieces(docs, capacity=capacity, keep_ids=keep_ids), "pieces"), capacity)


@register("op9_best_fit")
def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
