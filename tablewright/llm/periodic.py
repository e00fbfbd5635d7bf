"""Periodic runs of words, found by catching squares in blocks of a power of two.

Words are appended to a text. Every completed block of 8, 16, 32, ... words has a catcher.
It waits for its block to come again one to two block lengths later (the blocks of 8 from
one word later on): for each appended word, the suffix that now is one block long is
compared by hash with the catcher that may meet it, one for each size. What is caught is
extended to both sides, and goes on being extended as words are appended. Once both halves
are there it is a square; all squares of a period in one stretch are one run.

A run of at least three periods of d words, and 24 words, has a whole block of the size
for d in its words before the last period, at least one period before its end. So every
such run is caught.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable
from fractions import Fraction
from itertools import count

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import map_rows, register, table
from tablewright.llm.hashing import mixed

LEAST = 24  # words of a run
TIMES = 3  # periods of a run
BLOCK = 8  # words of the smallest block; three of these are LEAST
APPENDED = 1 << 16  # words appended at once
PRIME = np.uint64((1 << 31) - 1)
BASE = 1_220_703_125

Words = list[bytes]
Run = tuple[int, int, int]


class SquareCatcher:
    """Append numbers of words; ``runs`` gives the runs of what was appended so far. The
    work for each word is one comparison a block size, and the extension of what is caught."""

    def __init__(self, size: int = 1024):
        self.n = 0
        self.words = np.zeros(size, np.int64)
        self.sums = np.zeros(size + 1, np.uint64)  # of hash * BASE ** place, modulo PRIME, before each word
        self.powers = np.ones(size, np.uint64)
        self.cover = np.full(size, -1, np.int64)  # a square that a word is in
        self.low, self.high, self.period = (np.zeros(64, np.int64) for _ in range(3))
        self.found = 0
        self.last: dict[int, int] = {}  # the last stretch of each period
        self.open: list[int] = []  # stretches that reach to the end
        self.next: dict[tuple[int, bool], int] = {}
        self._raise_powers(1)

    def _raise_powers(self, known: int) -> None:
        while known < len(self.powers):
            more = min(known, len(self.powers) - known)
            step = np.uint64(pow(BASE, known, int(PRIME)))
            self.powers[known : known + more] = self.powers[:more] * step % PRIME
            known += more

    def _grow(self, size: int) -> None:
        old = len(self.words)
        if size > old:
            size = max(size, 2 * old)
            for name, fill in (("words", 0), ("powers", 1), ("cover", -1), ("sums", 0)):
                was = getattr(self, name)
                now = np.full(size + (name == "sums"), fill, was.dtype)
                now[: len(was)] = was
                setattr(self, name, now)
            self._raise_powers(old)

    def append(self, words: np.ndarray) -> None:
        start, end = self.n, self.n + len(words)
        self._grow(end)
        self.words[start:end] = words
        terms = mixed(words.astype(np.uint64)) % PRIME * self.powers[start:end] % PRIME
        self.sums[start + 1 : end + 1] = (np.cumsum(terms) + self.sums[start]) % PRIME
        self.n = end
        waiting, self.open = self.open, []
        for k in waiting:
            self._advance(k)
        self._catch(BLOCK, True)
        size = BLOCK
        while TIMES * size <= end:
            self._catch(size, False)
            size *= 2

    def _catch(self, size: int, near: bool) -> None:
        """Compare each new suffix with its catcher: that of the block before its own, or
        if ``near`` that of the block it begins in."""
        start = self.next.get((size, near), 0 if near else size)
        end = self.n - size + 1
        if end <= start:
            return
        self.next[size, near] = end
        first = start // size - 1
        edges = self.sums[max(first, 0) * size : end + size : size]
        blocks = (edges[1:] + PRIME - edges[:-1]) % PRIME
        at = np.arange(start, end)
        block = at // size - (0 if near else 1)
        gap = at - block * size
        caught = blocks[block - max(first, 0)] * self.powers[gap] % PRIME
        suffix = (self.sums[start + size : end + size] + PRIME - self.sums[start:end]) % PRIME
        hit = np.flatnonzero((caught == suffix) & (gap > 0))
        if not len(hit):
            return
        left, gap = block[hit] * size, gap[hit]
        rest = self._uncovered(left, gap, size)
        left, gap = left[rest], gap[rest]
        order = np.lexsort((left, gap))
        left, gap = left[order], gap[order]
        edges = [0, *(np.flatnonzero(np.diff(gap)) + 1), len(gap)]
        for a, b in zip(edges, edges[1:]):
            if a < b:
                mine, period = left[a:b], int(gap[a])
                mine = mine[self._uncovered(mine, gap[a:b], size)]
                while len(mine):
                    past = self._stretch(int(mine[0]), period)
                    mine = mine[np.searchsorted(mine, past) :]

    def _uncovered(self, left: np.ndarray, gap: np.ndarray, size: int) -> np.ndarray:
        """False where block and copy lie in squares whose period divides the gap: these
        would only be the same run again."""
        k = self.cover[left]
        if not self.found:
            return np.ones(len(k), bool)
        inside = (self.low[k] <= left) & (self.high[k] + self.period[k] >= left + gap + size)
        return ~((k >= 0) & inside & (gap % np.maximum(self.period[k], 1) == 0))

    def _same(self, at: int, period: int, forward: bool) -> int:
        """How many words from ``at`` on (or before it) equal those ``period`` later."""
        done, step = 0, 32
        limit = self.n - period - at if forward else at
        while done < limit:
            step = min(step, limit - done)
            a = at + done if forward else at - done - step
            equal = self.words[a : a + step] == self.words[a + period : a + period + step]
            if not equal.all():
                return done + int(np.argmin(equal if forward else equal[::-1]))
            done, step = done + step, min(2 * step, APPENDED)
        return done

    def _stretch(self, at: int, period: int) -> int:
        """The stretch of a period that a catch is in; its end."""
        k = self.last.get(period)
        if k is not None and at < self.high[k]:
            return int(self.high[k])
        right = self._same(at, period, True)
        if not right:
            return at + 1
        k, self.found = self.found, self.found + 1
        if k == len(self.low):
            self.low, self.high, self.period = (np.concatenate([x, np.zeros_like(x)]) for x in (self.low, self.high, self.period))
        self.low[k], self.high[k], self.period[k] = at - self._same(at, period, False), at + right, period
        self.last[period] = k
        self._advance(k)
        return int(self.high[k])

    def _advance(self, k: int) -> None:
        low, high, period = int(self.low[k]), int(self.high[k]), int(self.period[k])
        high += self._same(high, period, True)
        self.high[k] = high
        if high - low >= period:
            self.cover[low : high + period] = k
        if high + period == self.n:
            self.open.append(k)

    def runs(self, least: int = LEAST, times: int = TIMES) -> list[Run]:
        """(start, length, period) of all runs by start, with their smallest periods."""
        if least < LEAST or times < TIMES:
            raise ValueError(f"runs of under {LEAST} words or {TIMES} periods may not have been caught")
        found = self.found
        low, period = self.low[:found], self.period[:found]
        length = self.high[:found] - low + period
        whole = np.flatnonzero(length >= np.maximum(least, times * period))
        out: dict[tuple[int, int], int] = {}
        for a, n, p in zip(low[whole].tolist(), length[whole].tolist(), period[whole].tolist()):
            out[a, n] = min(p, out.get((a, n), p))
        return sorted((a, n, p) for (a, n), p in out.items())


def runs_of(words: Words, least: int = LEAST, times: int = TIMES) -> list[Run]:
    number = defaultdict(count().__next__)
    numbers = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    catcher = SquareCatcher(max(64, min(len(words), APPENDED)))
    for k in range(0, len(words), APPENDED):
        catcher.append(numbers[k : k + APPENDED])
    return catcher.runs(least, times)


def without_repeats(words: Words, runs: list[Run]) -> Words:
    """The words but for those in some run after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(keep)]


SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, best struct<start:long,length:long,period:long>, collapsed string"


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_of: Callable[[int | None, Words], Words] | None = None,
    least: int = LEAST,
    times: int = TIMES,
) -> DataFrame:
    """(doc_id, n_words, runs, best, collapsed) for each row of ``docs``.

    Words are what stands between ASCII white space. ``runs`` has all stretches of at least
    ``least`` words and ``times`` periods by start and period, each with its smallest period
    and as long as it can be; ``best`` is the one of the greatest exact length/period (ties:
    smallest start, then period), null if there is none. ``collapsed`` are the words that no
    run has after its first period, joined by spaces. ``words_of`` may replace the words of
    a document before.

    Null and empty texts have no words, no runs and collapse to an empty text. Null ids,
    ids that several rows have and repeated rows are kept, each row on its own; further
    columns are not read. An empty table gives no rows. Memory grows with a single text only.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def make():
        def step(ids, texts):
            out = ([], [], [], [], [])
            for doc_id, text in zip(ids, texts):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                if words_of is not None:
                    words = words_of(doc_id, words)
                runs = runs_of(words, least, times)
                best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
                named = [dict(zip(("start", "length", "period"), r)) for r in (*runs, *([best] if best else []))]
                text = b" ".join(without_repeats(words, runs)).decode("utf-8", "surrogatepass")
                for column, value in zip(out, (doc_id, len(words), named[: len(runs)], named[-1] if named else None, text)):
                    column.append(value)
            return out

        return step

    return map_rows(rows, make, SCHEMA)


def planted(doc_id: int | None, words: Words) -> Words:
    """The query's input: in about every tenth document, chosen by the id, the words from
    some place on repeat with a period. Without an id nothing is replaced."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    times = -(-(n - first) // period)
    return words[:first] + (words[first : first + period] * times)[: n - first]


def report(docs: DataFrame) -> DataFrame:
    rows = periodic_runs(docs, words_of=planted)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@register("op13_dyadic_runs")
def op13_dyadic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
