"""Quality rules: robust outliers by minimum-covariance-determinant estimates.

Statistics of each text are transformed to a vector. For each language, and for each
source of a language, the mean and covariance of the three quarters of the documents that
lie closest together are estimated by concentration steps, and documents far away by
Mahalanobis distance are rejected.

Every step is one aggregation over all vectors: by group and by bin of the logarithm of
the distance, counts and sums of fixed-point numbers. They are added up bin by bin until
the wanted share is reached. Integer sums have one value in any order, so the same rows
always give the same verdicts, and no group is ever in one task.
"""

from __future__ import annotations

import math
import string

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tablewright.llm.common import map_rows, register, table
from tablewright.session import materialize

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = string.punctuation.encode()
CAPITALS = string.ascii_uppercase.encode()

DIMENSIONS = ("word_length", "symbols", "punctuation", "capitals", "dup_lines", "repeats")
# Fixed point: numbers are kept in units of 1/1024. Transformed statistics are below 8, so
# sums of products stay below 2**63 for 10**11 documents of a group.
UNIT = 1024
CORE = 0.75  # share of a group's documents that the estimate is made of
STEPS = 5  # concentration steps
BINS = 24  # bins of distance for each factor e
# Smallest standard deviation of each statistic: most documents have no repeated line at
# all, so that the covariance of the core would be singular.
FLOOR = (0.06, 0.05, 0.05, 0.05, 0.12, 0.12)
PRIOR = 200  # a source's estimate weighs as its documents, its language's as so many
TAIL = 1e-7  # documents beyond the chi-squared quantile of 1 - TAIL are rejected
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words


def statistics(text: str) -> tuple[int, ...]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_punct, n_upper, n_lines)."""
    data = text.encode("utf-8", "surrogatepass")
    size, words = len(data), data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    chars = len(text) - (size - len(data.translate(None, WHITE)))
    drop = [size - len(data.translate(None, of)) for of in (SYMBOLS, PUNCTUATION, CAPITALS)]
    return (len(words), chars, drop[0], len(lines) - len(set(lines)), repeated_words(words), drop[1], drop[2], len(lines))


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """The words in windows of ``width`` words that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    window = ids[:n]
    for k in range(1, width):  # pairs are numbered anew where numbers would grow too large
        if int(window.max() + 1) * len(known) >= 1 << 62:
            window = np.unique(window, return_inverse=True)[1]
        window = window * len(known) + ids[k : k + n]
    _, which, counts = np.unique(window, return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    inside = np.zeros(len(words), dtype=bool)
    for k in range(width):
        inside[k : k + n] |= twice
    return int(inside.sum())


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document with its statistics, its two groups and its fixed-point vector."""
    key = lambda c: F.concat(F.when(F.col(c).isNull(), "-").otherwise("+"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.col(text_col).alias("text"),
        key(lang_col).alias("lang_key"),
        F.concat(key(lang_col), F.lit("\0"), key(source_col)).alias("source_key"),
    )
    counted = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_punct long, n_upper long, n_lines long"

    def make():
        def step(ids, hashes, values, langs, sources):
            found = np.array([statistics(v or "") for v in values], dtype=np.int64).reshape(len(values), 8)
            return [ids, hashes, langs, sources, *found.T]

        return step

    made = map_rows(rows, make, f"doc_id long, text_hash long, lang_key string, source_key string, {counted}")
    share = lambda a, b: F.sqrt(F.least(F.lit(1.0), F.col(a) / F.greatest(F.col(b), F.lit(1))))
    values = (
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        share("n_symbols", "word_chars"),
        share("n_punct", "word_chars"),
        share("n_upper", "word_chars"),
        share("n_dup_lines", "n_lines"),
        F.asin(share("n_repeat_words", "n_words")),
    )
    return made.select("*", *(F.least(F.round(v * UNIT), F.lit(8 * UNIT)).cast("long").alias(d) for v, d in zip(values, DIMENSIONS, strict=True)))


def chi2_cdf(x: float, p: int) -> float:
    """Of the chi-squared distribution with an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 0.0
    for k in range(p // 2):
        total += term
        term *= half / (k + 1)
    return 1 - math.exp(-half) * total


def chi2_tail_quantile(tail: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        half = mid / 2
        above = math.exp(-half) * sum(half**k / math.factorial(k) for k in range(p // 2))
        low, high = (mid, high) if above > tail else (low, mid)
    return high


def consistency(share: float, p: int) -> float:
    """What makes the covariance of the closest ``share`` of normal rows that of all."""
    return share / chi2_cdf(chi2_tail_quantile(1 - share, p), p + 2)


P = len(DIMENSIONS)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
SUMS = [*(f"s{i}" for i in range(P)), *(f"q{i}_{j}" for i, j in PAIRS)]
STATE = "key string, " + ", ".join([f"m{i} double" for i in range(P)] + [f"w{i}_{j} double" for i, j in PAIRS])


def _distance() -> Column:
    """Squared Mahalanobis distance of the row's vector to its group's state."""
    z = [F.col(d) / UNIT - F.col(f"m{i}") for i, d in enumerate(DIMENSIONS)]
    terms = [z[i] * z[j] * F.col(f"w{i}_{j}") * (1 if i == j else 2) for i, j in PAIRS]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


def _estimate(sums: DataFrame, factor: float) -> DataFrame:
    """(key, mean, covariance) from (key, n, sums), as flat columns m* and c*."""
    n = F.col("n").cast("double")
    mean = [F.col(f"s{i}") / n / UNIT for i in range(P)]
    cov = [(F.col(f"q{i}_{j}") / n / UNIT**2 - mean[i] * mean[j]) * factor for i, j in PAIRS]
    return sums.select("key", "n", *(m.alias(f"m{i}") for i, m in enumerate(mean)), *(c.alias(f"c{i}_{j}") for (i, j), c in zip(PAIRS, cov, strict=True)))


def _inverted(estimate: DataFrame) -> DataFrame:
    """The estimates with their covariances, floors added, inverted: rows of STATE."""

    def make():
        def step(keys, *columns):
            k = len(keys)
            means, covs = columns[:P], np.zeros((k, P, P))
            for (i, j), c in zip(PAIRS, columns[P:], strict=True):
                covs[:, i, j] = covs[:, j, i] = c
            inverse = np.linalg.inv(covs + np.diag(np.square(FLOOR)))
            return [keys, *means, *(inverse[:, i, j] for i, j in PAIRS)]

        return step

    return map_rows(estimate.select("key", *(f"m{i}" for i in range(P)), *(f"c{i}_{j}" for i, j in PAIRS)), make, STATE)


def _start(vectors: DataFrame) -> DataFrame:
    """Medians and quartile ranges of each statistic in each group: a first state."""
    one = F.explode(F.array(*(F.struct(F.lit(i).alias("d"), F.col(c).alias("v")) for i, c in enumerate(DIMENSIONS)))).alias("x")
    counts = vectors.select("key", one).groupBy("key", "x.d", "x.v").agg(F.count("*").alias("c"))
    by = Window.partitionBy("key", "d")
    ranked = counts.select("key", "d", "v", F.sum("c").over(by.orderBy("v")).alias("upto"), F.sum("c").over(by).alias("n"))
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("n") * q, F.col("v"))) / UNIT
    spread = ranked.groupBy("key", "d").agg(at(0.5).alias("m"), ((at(0.75) - at(0.25)) / 1.349).alias("s"))
    pick = lambda c, i: F.max(F.when(F.col("d") == i, F.col(c)))
    flat = spread.groupBy("key").agg(
        *(pick("m", i).alias(f"m{i}") for i in range(P)),
        *((pick("s", i) ** 2 if i == j else F.max(F.lit(0.0))).alias(f"c{i}_{j}") for i, j in PAIRS),
    )
    return _inverted(flat)


def _sums_within(vectors: DataFrame, state: DataFrame, share: float | None, radius: float | None = None) -> DataFrame:
    """(key, n, sums) over each group's closest rows: the ``share`` of them, rounded up to
    a whole bin of distance, or those within the squared distance ``radius``."""
    near = vectors.join(state, "key").withColumn("_d", _distance())
    if radius is not None:
        near = near.filter(F.col("_d") <= radius).withColumn("bin", F.lit(0))
    else:
        near = near.withColumn("bin", F.floor(F.log(F.col("_d") + 1e-6) * BINS).cast("int"))
    binned = near.groupBy("key", "bin").agg(
        F.count("*").alias("n"),
        *(F.sum(d).alias(f"s{i}") for i, d in enumerate(DIMENSIONS)),
        *(F.sum(F.col(DIMENSIONS[i]) * F.col(DIMENSIONS[j])).alias(f"q{i}_{j}") for i, j in PAIRS),
    )
    if share is not None:
        # no more rows here than groups times bins
        by = Window.partitionBy("key")
        before = F.coalesce(F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        binned = binned.withColumn("_before", before).withColumn("_all", F.sum("n").over(by)).filter(F.col("_before") < F.col("_all") * share)
    return binned.groupBy("key").agg(F.sum("n").alias("n"), *(F.sum(c).cast("double").alias(c) for c in SUMS))


def mcd(vectors: DataFrame) -> DataFrame:
    """(key, n, m*, c*): reweighted minimum-covariance-determinant estimates of each group
    of ``vectors`` (key, and the columns of DIMENSIONS as fixed-point integers)."""
    state = materialize(_start(vectors), "mcd")
    for _ in range(STEPS):
        core = _estimate(_sums_within(vectors, state, CORE), consistency(CORE, P))
        state = materialize(_inverted(core), "mcd")
    inner = _sums_within(vectors, state, None, chi2_tail_quantile(0.025, P))
    return _estimate(inner, consistency(0.975, P))


def verdicts(docs: DataFrame, tail: float = TAIL, prior: float = PRIOR, **columns: str) -> DataFrame:
    """(doc_id, the statistics, base_failed, kept, distance, text_hash) for each document.

    The estimate of a (language, source) is averaged with its language's, by their numbers
    of documents and ``prior``; a language's likewise with that of all documents. Documents
    that fail the base rules take no part in the estimates.

    Null text counts as empty (and fails the base rules). Null languages and sources are
    groups of their own. Null ids and repeated rows are kept, row by row; ties of distance
    are inside together. An empty table gives no rows. Further columns are not read.
    """
    stats = materialize(text_statistics(docs, **columns), "statistics")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    good = stats.filter(~failed)
    groups = F.explode(F.array(F.lit("*"), F.concat(F.lit("l"), "lang_key"), F.concat(F.lit("s"), "source_key"))).alias("key")
    estimates = materialize(mcd(good.select(groups, *DIMENSIONS)), "estimates")

    fields = [*(f"m{i}" for i in range(P)), *(f"c{i}_{j}" for i, j in PAIRS)]
    level = lambda letter, name: estimates.filter(F.col("key").startswith(letter)).select(F.expr("substring(key, 2)").alias(name), F.col("n").alias(f"n_{letter}"), *(F.col(f).alias(f"{letter}_{f}") for f in fields))
    names = good.select("lang_key", "source_key").distinct()
    everything = estimates.filter(F.col("key") == "*").select(*(F.col(f).alias(f"a_{f}") for f in fields), F.lit(1).alias("_one"))
    joined = (
        names.join(level("s", "source_key"), "source_key", "left")
        .join(level("l", "lang_key"), "lang_key", "left")
        .withColumn("_one", F.lit(1))
        .join(F.broadcast(everything), "_one")  # one row
    )
    own = lambda n: F.coalesce(F.col(n) / (F.col(n) + prior), F.lit(0.0))
    mixed = lambda f: own("n_s") * F.coalesce(F.col(f"s_{f}"), F.lit(0.0)) + (1 - own("n_s")) * (own("n_l") * F.coalesce(F.col(f"l_{f}"), F.lit(0.0)) + (1 - own("n_l")) * F.col(f"a_{f}"))
    state = materialize(_inverted(joined.select(F.col("source_key").alias("key"), *(mixed(f).alias(f) for f in fields))), "mcd")
    judged = stats.withColumn("_failed", failed).withColumn("_key", F.when(~failed, F.col("source_key"))).join(state.withColumnRenamed("key", "_key"), "_key", "left")
    distance = F.sqrt(_distance())
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.col("_failed").alias("base_failed"),
        (~F.col("_failed") & F.coalesce(distance <= math.sqrt(chi2_tail_quantile(tail, P)), F.lit(False))).alias("kept"),
        F.round(distance, 4).alias("distance"),
        "text_hash",
    )


@register("op1_mcd_outliers")
def op1_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"))
