import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tablewright.llm import packing, sharding, tokens
from tests.llm.conftest import edge_rows


def one_by_one(lengths, capacity):
    """Best fit decreasing, piece after piece."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room[room.index(min(fits))] -= n
        else:
            room.append(capacity - n)
    return sorted(room)


def test_plan_is_that_of_one_by_one():
    rng = random.Random(4)
    for capacity in (7, 16, 50, 100):
        for _ in range(40):
            lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 120))]
            counts = {n: lengths.count(n) for n in set(lengths)}
            used, placed = {}, dict.fromkeys(counts, 0)
            for length, rank, n, first, each, offset in packing.best_fit_decreasing(counts, capacity):
                assert rank == placed[length]
                placed[length] += n
                for k in range(n):
                    at = first + k // each
                    assert used.get(at, 0) == offset + k % each * length
                    used[at] = used.get(at, 0) + length
            assert placed == counts
            assert sorted(capacity - u for u in used.values()) == one_by_one(lengths, capacity)


def check_packed(rows, texts, capacity):
    encode = tokens.byte_bpe_encoder()
    ids = sorted(encode(t or "") + bytes(4) for t in texts)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sum(r["length"] for r in rows) == sum(len(i) // 4 for i in ids)
    assert len(by) == len(one_by_one([r["length"] for r in rows], capacity))


def test_packed(edge, nothing):
    rows = packing.packed(edge, capacity=256, keep_ids=True).collect()
    check_packed(rows, [r[1] for r in edge_rows()], 256)
    encode = tokens.byte_bpe_encoder()
    text = next(r[1] for r in edge_rows() if r[0] == 109)
    parts = sorted((r["piece"], r["start"], bytes(r["ids"]), r["ids_crc32"]) for r in rows if r["doc_id"] == 109)
    assert b"".join(p[2] for p in parts) == encode(text) + bytes(4)
    assert all(len(p[2]) == 1024 for p in parts[1:]) and all(zlib.crc32(p[2]) == p[3] for p in parts)
    assert [p[1] for p in parts] == np.cumsum([0, *(len(p[2]) // 4 for p in parts[:-1])]).tolist()
    assert packing.packed(nothing).isEmpty()


def test_shards(spark, edge, nothing, tmp_path):
    path = str(tmp_path / "map")
    rows = sharding.shard(edge, n_shards=4, map_path=path).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in edge_rows())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    for k in range(4):
        own = [r for r in rows if r["shard"] == k]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    assert sharding.shard(nothing).isEmpty()
    first, second = sharding.SlotMap.load(spark, path, 0), sharding.SlotMap.load(spark, path)
    assert (first.version, second.version) == (0, 1) and len(second.shards) == sharding.SLOTS
    assert all(r["shard"] == second.shards[r["vslot"]] for r in rows)


def test_rebalancing_is_even_and_moves_little():
    rng = random.Random(1)
    sizes = [int(rng.paretovariate(1.2) * 1000) for _ in range(4096)]
    balanced = sharding.SlotMap.first(4096, 16).rebalanced(sizes)
    loads = balanced.loads(sizes)
    assert max(loads) - min(loads) <= max(max(sizes), sum(sizes) // 1600)
    grown = balanced.rebalanced(sizes, 17)
    moved = [s for s in range(4096) if grown.shards[s] != balanced.shards[s]]
    assert sum(sizes[s] for s in moved) <= 0.15 * sum(sizes)
    assert max(grown.loads(sizes)) <= 1.05 * sum(sizes) / 17 + max(sizes)
    again = balanced.rebalanced(sizes)
    assert sum(a != b for a, b in zip(again.shards, balanced.shards)) <= 64
