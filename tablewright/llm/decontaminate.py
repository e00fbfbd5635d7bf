"""Benchmark decontamination: rare n-gram seeds, then local alignment.

Test items and documents are read as sequences of normalized words. Where a document has an
n-gram of an item, the passage around it is cut out, as far as an alignment with that item
may reach. The n-grams of all passages are counted, and each item is looked up by its
rarest ones: as many as it takes for a copy to have one of them, whichever of its n-grams
the edits have left (:func:`spared`). An n-gram may have one more word put in. Passage and item meet in a join and are aligned by
Smith and Waterman's recurrence, unless the passage has too few of the item's words for the
score. What scores at least a share of a perfect match is a copy, edited or not.

One narrow pass reads the texts, and no text is shuffled: tasks get tables of fixed size
that stand for the n-grams asked for and how far they reach, and only what these let pass
is joined exactly.
"""

from __future__ import annotations

import math
import re
import string
from functools import cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import map_rows, register, table
from tablewright.llm.hashing import MIX, Bits, WordHashes, mixed, runs
from tablewright.session import materialize

SEED = 3  # words of an n-gram
SHAPES = ((0, 1, 2), (0, 1, 3), (0, 2, 3))  # where they may stand in a document: one may be put in between
SCORE = 0.4  # of a perfect match
ERRORS = 1 / 3  # words edited for each that agrees, up to which no copy is missed
BITS = 24  # the bit table has 2 ** BITS bits, 2 MB
REACHES = 20  # the table of reaches has 2 ** REACHES numbers, 4 MB
CELLS = 4_000_000  # of one block of alignments

_PUNCTUATION = string.punctuation.encode()
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def _normal_hash(word: bytes) -> int:
    """Of the word without case and without what is no letter or digit at its ends."""
    core = word.strip(_PUNCTUATION)
    if core.isalnum():  # of ASCII alone: the same, in fewer steps
        return xxhash.xxh3_64_intdigest(core.lower()) | 1
    plain = _EDGE.sub("", word.decode("utf-8", "replace").casefold())
    return xxhash.xxh3_64_intdigest(plain) | 1 if plain else 0


class Words:
    """The hashes of a text's normalized words; what has no letter or digit is no word."""

    def __init__(self):
        self.hashes = WordHashes(make=_normal_hash)

    def of(self, text: str | None) -> np.ndarray:
        found = self.hashes.of((text or "").encode("utf-8", "surrogatepass").split())
        return found[found != 0]


@cache
def _words() -> Words:
    """One for a worker, so that its tasks share what they have hashed."""
    return Words()


def _shaped(words: np.ndarray) -> list[np.ndarray]:
    """For each of SHAPES, the n-gram that each word begins if its words stand at these
    places from there on; with places in a row, :func:`runs`. Equal beginnings are made once."""
    made = {(): np.full(len(words), SEED, dtype=np.uint64)}
    for places in SHAPES:
        for k, at in enumerate(places):
            if places[: k + 1] not in made:
                n = max(len(words) - at, 0)
                made[places[: k + 1]] = mixed(made[places[:k]][:n] * MIX[k] + words[at : at + n])
    return [made[places] for places in SHAPES]


def spared(n: int, score: float = SCORE, errors: float = ERRORS) -> int:
    """How many of the n-grams of an item of ``n`` words need not be looked up.

    An alignment of m words that agree and e errors has at most e + 1 stretches, so at
    least m - (SEED - 1) * (e + 1) n-grams of the item. With m - e >= score * n and
    e <= errors * m, that is least where e = errors * m. Of so many n-grams one is among
    those looked up, if one fewer than that is left out. (Words put in one by one leave
    n-grams besides, as documents are also read with a word left out: ``SHAPES``.)
    """
    left = score * n * (1 - (SEED - 1) * errors) / (1 - errors) - (SEED - 1)
    return max(math.ceil(round(left, 9)) - 1, 0)


def _items(benchmark: DataFrame, id_col: str, text_col: str, score: float) -> DataFrame:
    """(item_id, item, n, words, spare, grams): each item's words and its n-grams with the
    number of their places. ``item`` tells items of one id, or without id, apart."""

    def make():
        words = _words()

        def step(ids, values):
            found = [words.of(v) for v in values]
            grams, times = zip(*[np.unique(runs(f, SEED), return_counts=True) for f in found]) if found else ((), ())
            sizes = [len(f) for f in found]
            return [ids, sizes, [f.tobytes() for f in found], [spared(n, score) for n in sizes], [g.view(np.int64) for g in grams], times]

        return step

    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    made = map_rows(rows, make, "item_id long, n long, words binary, spare long, seeds array<long>, times array<long>")
    return made.withColumn("item", F.xxhash64("item_id", "words")).dropDuplicates(["item"])


def _reaches(grams: DataFrame) -> np.ndarray:
    """The most words of an item that has an n-gram, by the n-gram's low bits: others that
    share these can only make it more. The driver gets 2 ** REACHES rows at most."""
    place = F.col("seed").bitwiseAND(F.lit((1 << REACHES) - 1))
    rows = grams.groupBy(place.alias("place")).agg(F.max("n").alias("n")).toArrow()
    out = np.zeros(1 << REACHES, np.int32)
    out[rows["place"].to_numpy()] = rows["n"].to_numpy()
    return out


def _passages(docs: DataFrame, bits: Bits, reaches: np.ndarray, score: float) -> DataFrame:
    """(doc_id, text_hash, start, words, seeds): the passages with n-grams of items, each
    reaching beyond them on both sides as far as an alignment with such an item can;
    passages that touch are one. An n-gram with a word put in needs another one near by: a
    copy that has no other has many such words, and so many such n-grams."""
    shared = docs.sparkSession.sparkContext.broadcast((bits, reaches))

    def make():
        words, (wanted, reach) = _words(), shared.value
        low = np.uint64(len(reach) - 1)

        def step(ids, keys, values):
            out: list[list] = [[], [], [], [], []]
            for doc_id, key, value in zip(ids, keys, values, strict=True):
                found = words.of(value)
                shaped = _shaped(found)
                passed = [np.flatnonzero(wanted.has(grams)) for grams in shaped]
                hits, grams = np.concatenate(passed), np.concatenate([g[h] for g, h in zip(shaped, passed, strict=True)])
                if not len(hits):
                    continue
                longest = reach[(grams & low).astype(np.int64)].astype(np.int64)
                # a passage has as many words as agree, and at most 1 - score of the item's besides
                margin = longest + np.ceil(longest * (1 - score)).astype(np.int64)
                order = np.argsort(hits - margin, kind="stable")
                begin, end = (hits - margin)[order], np.maximum.accumulate((hits + SEED + 1 + margin)[order])
                cuts = np.flatnonzero(begin[1:] > end[:-1]) + 1
                for part in np.split(np.arange(len(hits)), cuts):
                    if len(part) == 1 and order[part[0]] >= len(passed[0]):
                        continue  # a single n-gram, and that with a word put in
                    start = max(0, int(begin[part[0]]))
                    passage = found[start : int(end[part[-1]])]
                    row = (doc_id, key, start, passage.tobytes(), np.unique(grams[order[part]]).view(np.int64))
                    for column, v in zip(out, row, strict=True):
                        column.append(v)
            return out

        return step

    return map_rows(docs, make, "doc_id long, text_hash long, start long, words binary, seeds array<long>")


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(best score, end in the passage) of the local alignment of each pair: a word that
    agrees counts 1, one that differs or is left out counts -1. A row of all pairs'
    tables is one step; the gap inside a row is a running maximum."""
    n, m = max(map(len, items)), max(map(len, passages))
    left, right = np.zeros((len(items), n), np.uint64), np.full((len(items), m), 2, np.uint64)
    for k, (a, b) in enumerate(zip(items, passages, strict=True)):
        left[k, : len(a)], right[k, : len(b)] = a, b
    slope = np.arange(m + 1, dtype=np.int32)
    above = np.zeros((len(items), m + 1), dtype=np.int32)
    best, end = np.zeros(len(items), np.int32), np.zeros(len(items), np.int64)
    for i in range(n):
        row = np.zeros_like(above)
        same = right == left[:, i : i + 1]
        row[:, 1:] = np.maximum(above[:, :-1] + np.where(same, 1, -1), above[:, 1:] - 1)
        np.maximum(row, 0, out=row)
        above = np.maximum.accumulate(row + slope, axis=1) - slope
        at = above.argmax(axis=1)
        value = above[np.arange(len(items)), at]
        better = value > best
        best[better], end[better] = value[better], at[better]
    return best, end


def _aligned(pairs: DataFrame, score: float) -> DataFrame:
    def make():
        def step(ids, keys, starts, passages, items, targets):
            a = [np.frombuffer(t, np.uint64) for t in targets]
            b = [np.frombuffer(p, np.uint64) for p in passages]
            best, begin, end = (np.zeros(len(a), np.int64) for _ in range(3))
            size = np.array([len(x) for x in a])
            # no alignment agrees in more words than the item has in the passage
            most = np.array([np.isin(x, y).sum() for x, y in zip(a, b, strict=True)])
            order, block = sorted(np.flatnonzero(most / size >= score).tolist(), key=lambda k: len(b[k])), []
            for k in [*order, None]:
                if block and (k is None or (len(block) + 1) * (len(b[k]) + 1) > CELLS):
                    x, y = [a[i] for i in block], [b[i] for i in block]
                    best[block], end[block] = align(x, y)
                    # where it begins is where the reversed alignment, from its end on, ends
                    back = align([v[::-1] for v in x], [v[: e][::-1] if e else v[:0] for v, e in zip(y, end[block], strict=True)])[1]
                    begin[block] = end[block] - back
                    block = []
                if k is not None:
                    block.append(k)
            at = np.array(starts, dtype=np.int64)
            share = best / size
            good = np.flatnonzero(share >= score)
            pick = lambda column: [column[i] for i in good]
            return [pick(ids), pick(keys), pick(items), share[good].round(4), (at + begin)[good], (at + end)[good]]

        return step

    return map_rows(pairs, make, "doc_id long, text_hash long, item_id long, score double, start_word long, end_word long")


def _rarest(grams: DataFrame, passages: DataFrame) -> DataFrame:
    """(item, seed): each item's n-grams without the most frequent ones that it can spare,
    counted by places in the item. Frequencies are those in all passages."""
    counts = passages.select(F.explode("seeds").alias("seed")).groupBy("seed").agg(F.count(F.lit(1)).alias("df"))
    frequent = Window.partitionBy("item").orderBy(F.desc("df"), "seed")  # one item's n-grams
    ranked = grams.join(counts, "seed").withColumn("_places", F.sum("times").over(frequent))
    return ranked.where("_places > spare").select("item", "seed")


def candidates(docs: DataFrame, benchmark: DataFrame, score: float = SCORE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, start, words, item_id, target): the passages that have one of an
    item's rarest n-grams, with the item; words as hashes. Each pair is one row."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    items = materialize(_items(benchmark, item_col, item_text_col, score), "items")
    zipped = F.explode(F.arrays_zip("seeds", "times")).alias("g")
    grams = items.select("item", "n", "spare", zipped).select("item", "n", "spare", F.col("g.seeds").alias("seed"), F.col("g.times").alias("times"))
    grams = materialize(grams, "seeds")
    found = materialize(_passages(source, Bits.of(grams, "seed", BITS), _reaches(grams), score), "passages")
    rare = materialize(_rarest(grams, found), "rare")
    met = found.select("doc_id", "text_hash", "start", F.explode("seeds").alias("seed")).join(rare, "seed").select("doc_id", "text_hash", "start", "item").distinct()
    same = F.col("p.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("p.text_hash") == F.col("m.text_hash")) & (F.col("p.start") == F.col("m.start"))
    passages = found.dropDuplicates(["doc_id", "text_hash", "start"]).drop("seeds")
    pairs = passages.alias("p").join(met.alias("m"), same).select("p.*", "m.item")
    return pairs.join(items.select("item", "item_id", F.col("words").alias("target")), "item").select("doc_id", "text_hash", "start", "words", "item_id", "target")


def contaminated(docs: DataFrame, benchmark: DataFrame, score: float = SCORE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, score, start_word, end_word): every document that has a
    copy of a test item, exact or edited, with the best such passage in normalized words.

    No copy is missed that has at most one edit for three words that agree; of those with
    more edits, such that have none of the item's rarest n-grams are.

    Null and wordless texts match nothing, nor do items of fewer than SEED words. Null ids
    are kept. Rows that repeat id and text give one row for an item; of equally good
    passages, the first. Items that share an id are each looked for, and the best counts.
    Either table may be empty. Further columns are not read.
    """
    pairs = candidates(docs, benchmark, score, id_col, text_col, item_col, item_text_col)
    best = F.max_by(F.struct("score", "start_word", "end_word"), F.struct("score", -F.col("start_word"))).alias("b")
    return _aligned(pairs, score).groupBy("doc_id", "text_hash", "item_id").agg(best).select("doc_id", "text_hash", "item_id", "b.*")


@register("op10_seed_align")
def op10_seed_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
