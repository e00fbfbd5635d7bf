"""Substring deduplication by sliding spans of sentences.

Every run of RUN consecutive sentences is hashed. Runs are joined over all documents, and
sentences covered by an occurrence of a run that is not its first are removed. Occurrences
are ordered by document id and by place in the document.

Texts are cut and hashed once; the runs of each document and where its sentences begin are
written. Two narrow passes read the runs: one counts them, the other sends on only those that
occur in several documents, let through by a filter of fixed size and then joined exactly.
Inside a document a run counts once, so that no line repeated in it makes a large group.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import map_rows, register, table
from tablewright.llm.hashing import Bits, runs, word_hashes
from tablewright.session import materialize

RUN = 3  # sentences of a run
WORDS = 24  # longer sentences are cut in pieces
NEAR = 3  # a piece begins at the least hash among so many words on both sides
PIECE = 12  # words of a piece, about: where no word is such a least one, the next is cut off
BITS = 24
LAST = (1 << 63) - 1

_END = re.compile(r"(?<=[.!?])\s+|\n+")
_WORD = re.compile(r"\S+")


def pieces(words: list[str]) -> list[int]:
    """Where the pieces of a long sentence begin. Equal words are cut alike, wherever in
    the sentence they stand: a piece begins at a word whose hash, taken with the next word,
    is less than those of the NEAR words before it and not more than those behind it. A
    piece has more than NEAR words. Where there is no such word for PIECE words, as in
    repeated ones, it begins at the least of these."""
    data = " ".join(words).lower().encode("utf-8", "surrogatepass").split(b" ")
    keys = word_hashes().runs(data, 2)
    n = len(keys)
    padded = np.full(n + 2 * NEAR, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[NEAR : NEAR + n] = keys
    least = np.ones(n, dtype=bool)
    for k in range(NEAR):
        least &= (keys < padded[k : k + n]) & (keys <= padded[NEAR + 1 + k : NEAR + 1 + k + n])
    out = [0]
    for at in [*np.flatnonzero(least).tolist(), len(words)]:
        while at - out[-1] > PIECE:
            a = out[-1] + NEAR + 1
            out.append(a + int(keys[a : min(out[-1] + PIECE, at - NEAR - 1) + 1].argmin()))
        if NEAR < at - out[-1] and at < len(words):
            out.append(at)
    return out


def sentences(text: str) -> tuple[list[int], np.ndarray]:
    """(where each sentence begins, a 128-bit hash of each as two numbers). A sentence ends
    with ``.``, ``!`` or ``?`` before white space, or with a line; of more than WORDS
    words, its :func:`pieces` count as sentences. White space and case do not matter to
    its hash. The first begins at 0."""
    starts, hashes, begin = [], [], 0
    for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        words = text[begin:end].split()
        if len(words) > WORDS:
            cuts = pieces(words)
            places = [m.start() + begin for m in _WORD.finditer(text[begin:end])]
            at = [begin, *(places[k] for k in cuts[1:])]
        else:
            cuts, at = [0], [begin] if words else []
        for start, a, b in zip(at, cuts, [*cuts[1:], len(words)]):
            starts.append(start)
            hashes.append(xxhash.xxh3_128_digest(" ".join(words[a:b]).lower().encode("utf-8", "surrogatepass")))
        begin = end
    if starts:
        starts[0] = 0
    return starts, np.frombuffer(b"".join(hashes), dtype=np.uint64).reshape(-1, 2)


def run_hashes(hashes: np.ndarray) -> np.ndarray:
    """[run, 2]: the hashes of all runs of RUN sentences."""
    return np.stack([runs(np.ascontiguousarray(hashes[:, k]), RUN) for k in range(2)], axis=1)


def _first_in(found: np.ndarray) -> np.ndarray:
    """The places of the first occurrence of each run in its document."""
    return np.sort(np.unique(found[:, 0], return_index=True)[1])


def _cut(rows: DataFrame) -> DataFrame:
    """(order_id, doc_key, steps, own, runs) for each row of (order_id, doc_key, text): how
    far each sentence begins behind the one before it, the places of runs that occurred
    earlier in the text, and the hashes of all others in order."""

    def make():
        def step(ids, keys, values):
            out: list[list] = [ids, keys, [], [], []]
            for value in values:
                starts, hashes = sentences(value)
                found = run_hashes(hashes)
                at = _first_in(found)
                steps = np.diff(np.array(starts, dtype=np.int32), prepend=np.int32(0))
                own = np.setdiff1d(np.arange(len(found), dtype=np.int32), at, assume_unique=True)
                for column, v in zip(out[2:], (steps, own, found[at].tobytes()), strict=True):
                    column.append(v)
            return out

        return step

    return map_rows(rows, make, "order_id long, doc_key long, steps array<int>, own array<int>, runs binary")


def _runs(cut: DataFrame, wanted: Bits | None) -> DataFrame:
    """(high, low, order_id[, doc_key, at]): the first occurrence of each run in each
    document; without a filter only the first three columns are made."""
    shared = cut.sparkSession.sparkContext.broadcast(wanted)

    def make():
        filter_ = shared.value

        def step(ids, keys, owns, values):
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for order_id, key, own, value in zip(ids, keys, owns, values, strict=True):
                found = np.frombuffer(value, np.uint64).reshape(-1, 2)
                if filter_ is None:
                    row = found[:, 0].view(np.int64), found[:, 1].view(np.int64), np.full(len(found), order_id)
                else:
                    take = np.flatnonzero(filter_.has(found[:, 0]))
                    at = np.setdiff1d(np.arange(len(found) + len(own)), own, assume_unique=True)[take]
                    row = found[take, 0].view(np.int64), found[take, 1].view(np.int64), np.full(len(at), order_id), np.full(len(at), key), at
                for column, v in zip(out, row, strict=False):
                    column.append(v)
            return [np.concatenate([*column, np.zeros(0, np.int64)]).astype(np.int64) for column in (out if wanted_all else out[:3])]

        return step

    wanted_all = wanted is not None
    return map_rows(cut.select("order_id", "doc_key", "own", "runs"), make, "high long, low long, order_id long" + (", doc_key long, at long" if wanted_all else ""))


def without_repeats(docs: DataFrame, keep_text: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_sentences, n_removed, n_spans, n_bytes_removed, kept_sha256[, kept]) for
    each document: what remains of its text.

    Null text counts as empty. A null id comes behind all others. Documents with one id (or
    none) do not lose sentences to each other; rows that repeat id and text are one
    document and give one row. Documents of fewer than RUN sentences keep everything. An
    empty table gives no rows. Further columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    keyed = source.select(F.coalesce("doc_id", F.lit(LAST)).alias("order_id"), F.xxhash64("text").alias("doc_key"), "text", F.col("doc_id").isNull().alias("no_id"))
    rows = keyed.select("order_id", "doc_key", "text")
    cut = materialize(_cut(rows), "sentences")
    shared = _runs(cut, None).groupBy("high", "low").agg(F.min("order_id").alias("first"), F.max("order_id").alias("last")).filter("first != last")
    shared = materialize(shared.select("high", "low", "first"), "shared_runs")
    again = _runs(cut, Bits.of(shared, "high", BITS)).join(shared, ["high", "low"]).filter("order_id > first")
    # the runs of one document
    lists = materialize(again.groupBy("order_id", "doc_key").agg(F.collect_set("at").alias("again")), "repeated_runs")
    places = cut.groupBy("order_id", "doc_key").agg(F.first("steps").alias("steps"), F.first("own").alias("own"))
    met = keyed.join(places, ["order_id", "doc_key"]).join(lists, ["order_id", "doc_key"], "left")
    met = met.select("order_id", "doc_key", "no_id", "text", "steps", "own", "again")

    def make():
        def step(ids, keys, missing, values, steps, owns, lists_):
            out: list[list] = [[], [], [], [], [], [], [], []]
            for order_id, key, none, value, steps_, own, again_ in zip(ids, keys, missing, values, steps, owns, lists_, strict=True):
                starts = np.cumsum(steps_, dtype=np.int64).tolist()
                gone, kept = removed(len(starts), own + (again_ or [])), [value]
                if gone.any():
                    edges = [*starts, len(value)]
                    kept = [value[a:b] for a, b, g in zip(edges, edges[1:], gone, strict=False) if not g]
                data, size = "".join(kept).encode("utf-8", "surrogatepass"), len(value.encode("utf-8", "surrogatepass"))
                n_spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                row = (None if none else order_id, key, len(starts), int(gone.sum()), n_spans, size - len(data), hashlib.sha256(data).hexdigest(), data.decode("utf-8", "replace") if keep_text else None)
                for column, v in zip(out, row, strict=True):
                    column.append(v)
            return out

        return step

    schema = "doc_id long, doc_key long, n_sentences long, n_removed long, n_spans long, n_bytes_removed long, kept_sha256 string, kept string"
    out = map_rows(met, make, schema).dropDuplicates(["doc_id", "doc_key"]).drop("doc_key")
    return out if keep_text else out.drop("kept")


def removed(n: int, late: list[int]) -> np.ndarray:
    """Which of ``n`` sentences go: those in a run at a place in ``late``, one that occurred
    earlier in the document or whose first occurrence in it is not the first of all."""
    gone = np.zeros(n, dtype=bool)
    at = np.array(late, dtype=np.int64)
    for k in range(RUN):
        gone[at + k] = True
    return gone


@register("op3_sentence_spans")
def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), keep_text=False)
