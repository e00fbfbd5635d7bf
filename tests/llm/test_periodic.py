import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tablewright.llm import periodic
from tests.llm.conftest import edge_rows


def brute(words):
    """All runs, by comparing the words of every distance."""
    n, out = len(words), {}
    for p in range(1, n // 3 + 1):
        k = 0
        while k < n - p:
            if words[k] != words[k + p]:
                k += 1
                continue
            a = k
            while k < n - p and words[k] == words[k + p]:
                k += 1
            if k - a + p >= max(24, 3 * p):
                out.setdefault((a, k - a + p), p)
    return sorted((a, n, p) for (a, n), p in out.items())


def some_texts(rng):
    for _ in range(250):
        kinds = rng.choice([1, 2, 3, 20])
        words = [rng.randrange(kinds) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 4)):
            p = rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 40])
            part = [rng.randrange(kinds) for _ in range(p)]
            words += (part * 9)[: rng.randint(p, 9 * p)] + [rng.randrange(30) for _ in range(rng.randint(0, 5))]
        if rng.random() < 0.3:
            words = words[: rng.randint(1, 60)] * rng.randint(2, 7)
        yield words[:600]
    a, b = [0], [0, 1]
    while len(b) < 500:
        a, b = b, b + a
    yield b  # runs everywhere, of many periods
    yield [0] * 500
    yield ([0] * 30 + [1]) * 12  # runs in runs


def test_every_run_and_no_other():
    rng = random.Random(5)
    some = 0
    for words in some_texts(rng):
        want = brute(words)
        some += bool(want)
        assert periodic.runs_of(words) == want
    assert some > 100


def test_one_word_at_a_time():
    rng = random.Random(6)
    for words in list(some_texts(rng))[::7]:
        catcher = periodic.SquareCatcher(4)
        for k, w in enumerate(words):
            catcher.append(np.array([w]))
            if k % 50 == 49:
                assert catcher.runs() == brute(words[: k + 1])
        assert catcher.runs() == brute(words)
        pieces, at = periodic.SquareCatcher(4), 0
        while at < len(words):
            step = rng.randint(1, 90)
            pieces.append(np.array(words[at : at + step]))
            at += step
        assert pieces.runs() == brute(words)


def test_very_long_texts():
    words = [str(k) for k in range(777)] * 300
    assert periodic.runs_of(words) == [(0, len(words), 777)]
    assert periodic.runs_of(["a"] * 300_000) == [(0, 300_000, 1)]
    words = ([*"ab"] * 20 + [*"xyz"] * 10) * 2000
    runs = periodic.runs_of(words)
    assert (0, len(words), 70) in runs and len(runs) == 4001


def test_shorter_limits_are_refused():
    with pytest.raises(ValueError):
        periodic.SquareCatcher().runs(least=10)


def want(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words) if n < 4000 else None
    if runs is None:
        return None
    keep = [w for i, w in enumerate(words) if not any(s + p <= i < s + length for s, length, p in runs)]
    sha = lambda x: hashlib.sha256(x).hexdigest()
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()), sha(b" ".join(keep)))


def test_report(spark, edge, nothing):
    text = " ".join(str(k % 700) for k in range(900))
    rows = [(k, text) for k in range(60)] + [(k, "one two three") for k in range(40)] + [(None, "x " * 40), (10, None)]
    got = {tuple(r) for r in periodic.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {want(*r) for r in rows} and sum(r[1] > 0 for r in got) > 3
    rows = {(r[0], r[1]) for r in edge_rows()}
    got = [tuple(r) for r in periodic.report(edge).collect()]
    assert len(got) == len(edge_rows())
    assert {w for w in (want(*r) for r in rows) if w} <= set(got)
    assert len({r[0] for r in got} - {w[0] for w in (want(*r) for r in rows) if w}) <= 1  # one is too long for the plain way
    assert periodic.report(nothing).isEmpty()
