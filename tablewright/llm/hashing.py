"""64-bit hashes of words and of runs of words, and filters of fixed size."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import map_rows
from tablewright.llm.tokens import Memo

# odd multipliers of the positions in a run
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHashes:
    """Hashes of words, each distinct word hashed once while it is remembered."""

    def __init__(self, make: Callable[[bytes], int] = xxhash.xxh3_64_intdigest):
        self.memo = Memo(make)

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.memo.__getitem__, words), dtype=np.uint64, count=len(words))

    def runs(self, words: list[bytes], width: int) -> np.ndarray:
        """The hash of every run of ``width`` words, in order."""
        return runs(self.of(words), width)


@cache
def word_hashes() -> WordHashes:
    """One for a worker, so that its tasks share what they have hashed."""
    return WordHashes()


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    n = len(hashes) - width + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = mixed(out * MIX[k % len(MIX)] + hashes[k : k + n])
    return out


class Bits:
    """A Bloom filter of 64-bit keys, of fixed size whatever the number of keys: what it
    lets pass has to be joined exactly. With very many keys it lets all pass."""

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = bits
        self.words = np.zeros(1 << (bits - 6), dtype=np.uint64) if words is None else words

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.uint64((1 << self.bits) - 1)
        first = mixed(keys)
        return (first & low).astype(np.int64), (mixed(first) & low).astype(np.int64)

    @classmethod
    def of(cls, keys: DataFrame, column: str, bits: int) -> Bits:
        """Made in the tasks; the driver gets its words only, 2 ** bits / 64 at most."""
        empty = cls(bits, np.zeros(0, np.uint64))

        def make():
            def step(values):
                at = np.concatenate(empty._places(np.array(values, dtype=np.int64).view(np.uint64)))
                return [at >> 6, (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)]

            return step

        words = map_rows(keys.select(column), make, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits"))
        rows = words.toArrow()
        out = cls(bits)
        out.words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
        return out

    def has(self, keys: np.ndarray) -> np.ndarray:
        first, second = self._places(keys)
        test = lambda at: (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
        return (test(first) & test(second)).astype(bool)
