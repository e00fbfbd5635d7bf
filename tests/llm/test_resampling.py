import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from tablewright.llm import resampling
from tests.llm.conftest import edge_rows


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute(rows, target):
    source, aim = Counter(), Counter()
    for _, text in rows:
        source.update(features(text)[1])
    for text in target:
        aim.update(features(text)[1])
    s_all, t_all = sum(source.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s_all + 10000) / ((source[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for doc_id, text in rows:
        n_words, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], -1 if r[0] is None else r[0], r[3], r[2], r[1]))
    for rank, r in enumerate(fit[: 25 * len(fit) // 100], 1):
        r[5] = rank
    return out


def same(got, want):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(map(tuple, want), key=key)


def test_planes_are_exact():
    rng = np.random.default_rng(3)
    for buckets in (1, 64, 100, 10_000):
        for top in (2, 300, 1 << 33):
            counts = rng.integers(0, top, buckets) * (rng.random(buckets) < 0.3)
            gain = rng.integers(-(1 << 15), 1 << 15, buckets)
            assert resampling.Gains.of(gain).total(resampling.sliced(counts)) == int((counts * gain).sum())
    assert resampling.Gains.of(np.zeros(7, np.int64)).total(resampling.sliced(np.zeros(7, np.int64))) == 0


def test_against_brute_force(spark, edge, nothing):
    rng = random.Random(8)
    words = [f"w{k}é" if k % 7 == 0 else f"W{k}" for k in range(300)]
    made = lambda n, low: " ".join(words[int(low + (len(words) - low) * rng.random() ** 2)] + rng.choice([",", " ", "-", ""]) for _ in range(n))
    rows = [(k, made(rng.randint(0, 120), rng.choice([0, 200]))) for k in range(300)] + [(k, None) for k in (3, None)]
    rows += [(900 + k, rows[5][1]) for k in range(150)] + rows[:20] + [(7, rows[9][1])] * 3  # a third are copies
    aims = [made(60, 200) for _ in range(20)] + [None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(a,) for a in aims], "text string")
    want = brute(rows, aims)
    same(resampling.resampled(docs, target).collect(), want)
    assert sum(r[5] is not None for r in want) == 25 * sum(r[1] >= 20 for r in want) // 100
    short = [(r[0], r[1]) for r in edge_rows()]
    same(resampling.resampled(edge, edge.limit(0)).collect(), brute(short, []))
    assert resampling.resampled(nothing, target).isEmpty()
    few = spark.createDataFrame(rows[:3], "doc_id long, text string")
    same(resampling.resampled(few, target).collect(), brute(rows[:3], aims))


def test_draws_are_like_the_target(spark):
    rng = random.Random(9)
    sides = [[f"{c}{k}" for k in range(200)] for c in "ab"]
    rows = [(k, " ".join(rng.choice(sides[k % 10 == 0]) for _ in range(80))) for k in range(600)]
    target = spark.createDataFrame([(" ".join(sides[1]),)] * 30, "text string")
    found = resampling.resampled(spark.createDataFrame(rows, "doc_id long, text string"), target, percent=10)
    drawn = [r["doc_id"] % 10 == 0 for r in found.collect() if r["rank"]]
    assert len(drawn) == 60 and sum(drawn) > 30  # by chance it were 6
