"""Sharding by fixed virtual slots and a versioned map from slots to shards.

A record's slot is a hash of its id and never changes. Only the map from slots to shards
does: a version is made from the version before it by moving as few slots as balance
needs. Bytes are summed by slot, so that balancing looks at some thousands of sums,
whatever the number of records.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tablewright.llm.common import register, table, texts
from tablewright.session import materialize

SLOTS = 4096
SHARDS = 16


@dataclass(frozen=True)
class SlotMap:
    """One version of the map: ``shards[slot]`` is the slot's shard."""

    version: int
    shards: tuple[int, ...]

    @staticmethod
    def first(slots: int, n_shards: int) -> SlotMap:
        """Version 0: slots dealt out in turn, before any size is known."""
        return SlotMap(0, tuple(s % n_shards for s in range(slots)))

    @property
    def n_shards(self) -> int:
        return max(self.shards) + 1

    def loads(self, sizes: list[int], n_shards: int | None = None) -> list[int]:
        out = [0] * (n_shards or self.n_shards)
        for slot, shard in enumerate(self.shards):
            out[shard] += sizes[slot]
        return out

    def rebalanced(self, sizes: list[int], n_shards: int | None = None) -> SlotMap:
        """The next version: near equal loads on ``n_shards`` shards (as many as now if
        None) with few moves. Shards above the mean give slots away, largest that fit
        first; these go, largest first, to the shard with the least load; then single
        slots move or are swapped between the fullest and the emptiest shard while that
        narrows the gap."""
        n = n_shards or self.n_shards
        where = list(self.shards)
        loads = self.loads(sizes, max(n, self.n_shards))
        members: list[list[int]] = [[] for _ in loads]
        for slot, shard in enumerate(where):
            members[shard].append(slot)
        mean = sum(sizes) / n
        pool = []
        for shard, own in enumerate(members):
            for slot in sorted(own, key=lambda s: -sizes[s]):
                if shard >= n or sizes[slot] and loads[shard] - sizes[slot] >= mean:
                    loads[shard] -= sizes[slot]
                    pool.append(slot)
        heap = [(loads[s], s) for s in range(n)]
        heapq.heapify(heap)
        for slot in sorted(pool, key=lambda s: (-sizes[s], s)):
            load, shard = heapq.heappop(heap)
            where[slot] = shard
            heapq.heappush(heap, (load + sizes[slot], shard))
        return SlotMap(self.version + 1, tuple(_evened(where, sizes, n)))

    def frame(self, spark: SparkSession) -> DataFrame:
        """(version, vslot, shard): one row for each slot."""
        rows = [(self.version, slot, shard) for slot, shard in enumerate(self.shards)]
        return spark.createDataFrame(rows, "version int, vslot int, shard int")

    def save(self, spark: SparkSession, path: str) -> None:
        """Add this version to the stored map; older versions stay readable."""
        self.frame(spark).coalesce(1).write.mode("append").partitionBy("version").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A stored version, or the newest. A version has one row for each slot."""
        stored = spark.read.parquet(path)
        if version is None:
            version = stored.agg(F.max("version")).first()[0]
        rows = stored.filter(F.col("version") == version).orderBy("vslot").collect()
        return SlotMap(version, tuple(r["shard"] for r in rows))


def _evened(where: list[int], sizes: list[int], n: int) -> list[int]:
    """Move or swap slots between the fullest and the emptiest shard while it helps."""
    loads, members = [0] * n, [set() for _ in range(n)]
    for slot, shard in enumerate(where):
        loads[shard] += sizes[slot]
        members[shard].add(slot)
    for _ in range(4 * n):
        high = max(range(n), key=lambda s: loads[s])
        low = min(range(n), key=lambda s: loads[s])
        gap = loads[high] - loads[low]
        give = sorted(((sizes[s], s) for s in members[high]), reverse=True)
        take = sorted([(0, -1), *((sizes[s], s) for s in members[low])])
        best, j = (gap, -1, -1), len(take) - 1
        for size, slot in give:  # the difference nearest to half the gap, by two pointers
            while j > 0 and size - take[j][0] < gap / 2:
                j -= 1
            for k in (j, j + 1):
                if k < len(take) and 0 < (moved := size - take[k][0]) < gap:
                    best = min(best, (abs(gap - 2 * moved), slot, take[k][1]))
            j = len(take) - 1 if j <= 0 else min(j + 1, len(take) - 1)
        if best[1] < 0 or best[0] >= gap:
            return where
        for slot, source, target in ((best[1], high, low), (best[2], low, high)):
            if slot >= 0:
                members[source].remove(slot)
                members[target].add(slot)
                where[slot] = target
                loads[source] -= sizes[slot]
                loads[target] += sizes[slot]
    return where


def slotted(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, vslot): each record's size in bytes and virtual slot.

    The slot is a hash of the id alone; a record without id takes a hash of its text.
    """
    crc = F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(crc)).otherwise(F.xxhash64("doc_id"))
    return texts(docs, id_col, text_col).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
        crc.alias("text_crc32"),
        F.pmod(key, F.lit(slots)).cast("int").alias("vslot"),
    )


def shard(
    docs: DataFrame,
    n_shards: int = SHARDS,
    slots: int = SLOTS,
    previous: SlotMap | None = None,
    map_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Put every record into one of ``n_shards`` shards of near equal bytes.

    Returns (doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot, version):
    ``slot`` is the record's place in its shard, without gaps from 0, ``vslot`` its virtual
    slot, ``version`` the version of the map that placed it. ``previous`` is the map to
    edit (by default version 0); with ``map_path`` the new version is stored there.

    Null text: no bytes, size 1. Null ids are kept. Repeated rows each take a place of
    their own. An empty table gives no rows. Further columns are not read.
    """
    spark = docs.sparkSession
    rows = materialize(slotted(docs, slots, id_col, text_col), "slotted")
    sizes, counts = [0] * slots, [0] * slots
    # one row for each slot: bounded by the number of slots
    for r in rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect():
        sizes[r["vslot"]], counts[r["vslot"]] = r["bytes"], r["n"]
    current = previous or SlotMap.first(slots, n_shards)
    if previous is None and map_path:
        current.save(spark, map_path)
    placed = current.rebalanced(sizes, n_shards)
    if map_path:
        placed.save(spark, map_path)
    start, filled = [], [0] * n_shards
    for slot, at in enumerate(placed.shards):
        start.append((slot, at, filled[at]))
        filled[at] += counts[slot]
    # one row for each slot: its size is bounded by the number of slots, not by the data
    places = F.broadcast(spark.createDataFrame(start, "vslot int, shard int, before long"))
    order = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("rank", F.row_number().over(order).cast("long") - 1)
        .join(places, "vslot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("before") + F.col("rank")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "vslot",
            F.lit(placed.version).alias("version"),
        )
    )


@register("op8_slots")
def op8_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
