"""Importance resampling towards a target distribution by bit-sliced aggregation.

A text's features, its words and pairs of words, are counted by bucket. The counts are
stored bit by bit: plane j has one bit for each bucket, bit j of its count. The gains of
the buckets are sliced likewise, positive and negative ones apart. The sum of a text's
gains is then the sum over all pairs of planes of the population count of their AND, times
a power of two: exact whole numbers, whatever the order.
"""

from __future__ import annotations

from binascii import crc32
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tablewright.llm.common import map_rows, register, table
from tablewright.session import materialize

BUCKETS = 10_000
LEAST_WORDS = 20
DRAWN = 25  # percent
SEED = 7

# A-Z become a-z, other ASCII signs but digits end words
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LETTERS).split()


def feature_buckets(words: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of every word, then of every two consecutive words joined by a space."""
    n = len(words)
    hashes = np.empty(max(2 * n - 1, 0), np.int64)
    if n:
        singles = list(map(crc32, words))
        hashes[:n] = singles
        hashes[n:] = list(map(crc32, words[1:], map(crc32, repeat(b" "), singles[:-1])))
    return hashes % buckets


def sliced(counts: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative whole numbers, lowest first, as 64-bit words."""
    planes = max(1, int(counts.max(initial=0)).bit_length())
    bits = np.zeros((planes, -(-len(counts) // 64) * 64), np.uint8)
    for j in range(planes):
        bits[j, : len(counts)] = counts >> j & 1
    return np.packbits(bits, axis=1).view(np.uint64)


@dataclass(frozen=True)
class Gains:
    """Bit planes of the positive and of the negative gains."""

    above: np.ndarray
    below: np.ndarray

    @classmethod
    def of(cls, gains: np.ndarray) -> Gains:
        return cls(sliced(np.maximum(gains, 0)), sliced(np.maximum(-gains, 0)))

    def total(self, planes: np.ndarray) -> int:
        """The sum of count * gain over all buckets."""
        out = 0
        for sign, mine in ((1, self.above), (-1, self.below)):
            common = np.bitwise_count(planes[:, None, :] & mine[None, :, :]).sum(axis=2, dtype=np.int64)
            out += sign * sum(int(x) << (j + k) for (j, k), x in np.ndenumerate(common))
        return out


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) for the buckets with a feature in some text. Each task adds up what it
    reads, so a row for each bucket and task is shuffled."""
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts += np.bincount(feature_buckets(words_of(text), buckets), minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], schema=schema)

    rows = df.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """1000 times the logarithm of how much more frequent each bucket is in the target than
    in the source (both as :func:`bucket_counts`), with one more feature in every bucket.
    The driver gets two numbers a bucket, whatever the size of the tables."""
    both = source.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
    both = both.unionByName(target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    rows = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).toArrow()
    s, t = np.zeros(buckets), np.zeros(buckets)
    at = rows["bucket"].to_numpy()
    s[at], t[at] = rows["s"].to_numpy(), rows["t"].to_numpy()
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) for each row of ``docs``: the mean gain of the
    text's features, rounded down; 0 without features."""
    planes = Gains.of(gain)
    buckets = len(gain)

    def make() -> Callable:
        def step(ids, texts):
            n_words, n_features, weight = [], [], []
            for text in texts:
                words = words_of(text)
                features = feature_buckets(words, buckets)
                n_words.append(len(words))
                n_features.append(len(features))
                total = planes.total(sliced(np.bincount(features, minlength=buckets))) if len(features) else 0
                weight.append(total // max(1, len(features)))
            return ids, n_words, n_features, weight

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(rows, make, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """1000 times a Gumbel variate, rounded down, that depends on the id and the seed only."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = DRAWN,
    least: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for each row of ``docs``.

    ``weight`` says how much more a text is like ``target`` (its column ``text_col``) than
    like ``docs``. ``score`` adds noise, so that taking the highest scores draws without
    replacement in proportion to exp(weight / 1000). Of the N rows of at least ``least``
    words the floor(percent * N / 100) highest scores get ranks from 1 on, ties by id (null
    first); the others have none.

    Null and empty texts have no words and weight 0. A null id draws its noise as ``null``.
    Repeated rows count each and get ranks of their own. An empty table, or an empty
    target, is no case of its own: every bucket counts one feature more. Further columns
    are not read.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    gain = gains(bucket_counts(own, buckets=buckets), bucket_counts(target, text_col, buckets), buckets)
    rows = weights(own, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    rows = materialize(rows, "weights")
    # Rows by score: scores are whole numbers in a range that the gains bound, so this is a
    # small table, and as noise spreads equal texts no score has a large part of all rows.
    fit = F.col("n_words") >= least
    tally = rows.filter(fit).groupBy("score").agg(F.count("*").alias("here"))
    above = F.sum("here").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1))
    tally = tally.withColumn("above", F.coalesce(above, F.lit(0)))
    share = F.floor(F.lit(percent) * F.sum("here").over(Window.partitionBy()) / 100)
    tally = materialize(tally.select(F.col("score").alias("of"), "above", share.cast("long").alias("wanted")).filter("above < wanted"), "scores")
    here = F.row_number().over(Window.partitionBy("of").orderBy("doc_id", "weight", "n_features", "n_words"))
    rank = F.when(F.col("of").isNotNull(), F.col("above") + here).cast("long")
    found = rows.join(tally, fit & (F.col("score") == F.col("of")), "left")
    drawn, rest = found.filter("of is not null"), found.filter("of is null")
    drawn = drawn.withColumn("rank", rank)
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= F.col("wanted"), F.col("rank")))
    rest = rest.withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("doc_id", "n_words", "n_features", "weight", "score", "rank")


# The checksum is taken byte by byte with a table that is made from its polynomial.
REPORT_SQL = rf"""
WITH crc AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tbl
  FROM (SELECT unnest(range(256)) AS i)),
texts AS (
  SELECT row_number() OVER () AS n, doc_id, text FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, text FROM benchmark),
split AS (
  SELECT n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM texts),
features AS (
  SELECT n, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature FROM split),
hashed AS (
  SELECT feature, xor(list_reduce([4294967295] || list_transform(range(len(h) // 2), lambda i: CAST('0x' || h[2 * i + 1 : 2 * i + 2] AS BIGINT)),
    lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT feature, hex(feature) AS h FROM features), crc),
counted AS (SELECT n, bucket, count(*) AS k FROM features JOIN hashed USING (feature) GROUP BY ALL),
totals AS (SELECT bucket, sum(k) FILTER (n > 0) AS s, sum(k) FILTER (n < 0) AS t FROM counted GROUP BY bucket),
every AS (SELECT sum(s)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM totals),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (s_all + {BUCKETS}) / ((coalesce(s, 0)::DOUBLE + 1) * (t_all + {BUCKETS})))) AS BIGINT) AS g
  FROM totals, every),
sums AS (SELECT n, sum(k) AS n_features, sum(k * g) AS total FROM counted JOIN gain USING (bucket) GROUP BY n),
weighed AS (
  SELECT n, doc_id, len(words) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
    coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
    CAST('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, 'null'))[1:8] AS BIGINT) AS h
  FROM split LEFT JOIN sums USING (n) WHERE n > 0),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM weighed),
ranked AS (
  SELECT n, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, weight, n_features, n_words) AS rank, count(*) OVER () AS fit
  FROM scored WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {DRAWN} * fit // 100 THEN rank END AS rank FROM scored LEFT JOIN ranked USING (n)
"""


@register("op12_bit_sliced", REPORT_SQL)
def op12_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
