"""Licence scans through a positional index of rare words, in DataFrame operations only.

Templates are short phrases and notices. Their words, but for function words and numbers,
are indexed: for each, where it stands in which template. In each file the places of these
words are found, and their document frequencies give inverse frequencies. A file is looked
up by its highest-IDF word of each template; the postings of the other words are intersected
with these candidates by relative position, that is by where the template would begin.
What is found of a template at one beginning gives its score; a phrase counts if it is found
whole, a notice if at least half of its weight and all of its mandatory phrases are.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import fresh, register, table
from tablewright.session import materialize

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHARE = 0.5  # of a notice's weight


@dataclass(frozen=True)
class Template:
    """``label`` is given to a file that has ``text``. Phrases (``keys`` empty) count where
    all their words stand one behind the other. A notice may have other words in it; it
    counts with all of its ``keys``, anywhere in the file, and half of its weight at one
    beginning."""

    label: str
    text: str
    keys: tuple[str, ...] = ()


# The phrases that the contract of the query names.
BASE = (
    Template("gpl", "gnu general public license"),
    Template("apache", "apache license"),
    Template("cc-by", "cc by"),
    Template("mit", "mit license"),
)
# Notices as the licences word them, in words.
MORE = (
    Template("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("cc-by-nc", "licensed under cc by nc", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd", ("cc by nd",)),
    Template("cc-by-sa", "licensed under cc by sa", ("cc by sa",)),
    Template("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license version 3",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("unlicense", "free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)
# Words too common to be looked up, which may only stand between others.
COMMON = frozenset("a and any are by for in is of or that the this to under use with without 0 1 2 3 4 5 v version".split())


@dataclass(frozen=True)
class Posting:
    """Where a word stands in a template (or in a mandatory phrase of it)."""

    word: str
    unit: str
    label: str
    role: str  # base, key or notice
    at: int
    size: int
    rare: bool


def postings(base: tuple[Template, ...], more: tuple[Template, ...]) -> list[Posting]:
    units = {("base", t.text): t.label for t in base}
    units |= {("key", k): "" for t in more for k in t.keys or (t.text,)}
    units |= {("notice", t.text): t.label for t in more}
    out = []
    for (role, text), label in units.items():
        words = text.split()
        common = COMMON if any(w not in COMMON for w in words) else frozenset()
        out += [Posting(w, f"{role}:{text}", label, role, k, len(words), w not in common) for k, w in enumerate(words)]
    return out


def reach(index: list[Posting]) -> int:
    """How far a common word of a phrase is from a rare one of it, at most."""
    far = 0
    for p in index:
        if not p.rare and p.role != "notice":
            far = max(far, min(abs(p.at - q.at) for q in index if q.unit == p.unit and q.rare))
    return far


def lowered(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def licence_words(docs: DataFrame, index: list[Posting]) -> DataFrame:
    """(doc_id, text_hash, n_words, places) for each row of ``docs`` (doc_id, text): the
    places (at, word) of rare words of the index, and of its common ones close to these."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rare = sorted({p.word for p in index if p.rare})
    common = sorted({p.word for p in index if not p.rare and p.role != "notice"} - set(rare))
    near = [k for d in range(1, reach(index) + 1) for k in (-d, d)]

    def wanted(words: Column, i: Column) -> Column:
        close = [F.coalesce(F.get(words, i + k).isin(rare), F.lit(False)) for k in near]
        out = F.get(words, i).isin(rare)
        for c in close[1:]:
            close[0] = close[0] | c
        return out | (F.get(words, i).isin(common) & close[0]) if common and close else out

    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.array_remove(F.split(lowered(text), SEPARATORS), "").alias("words"))
    size = F.size("words")
    numbers = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    at = F.filter(numbers, lambda i: wanted(F.col("words"), i))
    places = F.transform(at, lambda i: F.struct(i.cast("long").alias("at"), F.get("words", i).alias("word")))
    return rows.select("doc_id", "text_hash", size.cast("long").alias("n_words"), places.alias("places"))


def _values(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A table of constants, without Python tasks."""
    return spark.sql(f"SELECT * FROM VALUES {', '.join(map(repr, rows))} AS t({names})")


def weighted(index: list[Posting], frequency: dict[str, int], n_docs: int) -> list[tuple]:
    """Postings with weights: the inverse document frequency of rare words in thousandths,
    at least 1; none for common words. Rounded down to whole numbers, so that sums are exact."""
    weight = {p.word: 1 + math.floor(1000 * math.log((n_docs + 1) / (frequency.get(p.word, 0) + 1))) for p in index}
    of = lambda p: weight[p.word] if p.rare else 0
    total: dict[str, int] = {}
    for p in index:
        total[p.unit] = total.get(p.unit, 0) + of(p)
    return [(p.word, p.unit, p.label, p.role, p.at, p.size, of(p), total[p.unit]) for p in index]


def beginnings(places: DataFrame, index: list[Posting], n_docs: int) -> DataFrame:
    """(doc_id, text_hash, unit, label, role, size, start, n, share): where templates would
    begin in files, how many of their words stand where they should, and the share of the
    template's weight that these have. Only beginnings at which the file's highest-IDF word
    of the template stands right."""
    spark = places.sparkSession
    some = places.filter(F.size("places") > 0).dropDuplicates(["doc_id", "text_hash"])
    own = sorted({p.word for p in index if p.rare})
    # the driver gets a number for each word of the templates
    seen = some.select(F.explode(F.array_distinct("places.word")).alias("word")).filter(F.col("word").isin(own))
    frequency = {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.count("*").alias("n")).toLocalIterator()}
    table = _values(spark, weighted(index, frequency, n_docs), "word, unit, label, role, place, size, weight, total")
    found = some.select("doc_id", "text_hash", F.inline("places")).join(F.broadcast(table), "word")
    key = ["doc_id", "text_hash", "unit"]
    start = (F.col("at") - F.col("place")).cast("long")
    met = found.groupBy(*key, "label", "role", "size", "total", start.alias("start")).agg(
        F.count("*").alias("n"),
        F.sum("weight").alias("weight"),
        F.max(F.struct("weight", "word")).alias("best"),
    )
    met = materialize(met, "beginnings")
    rarest = met.groupBy(*key).agg(F.max("best").alias("anchor")).filter("anchor.weight > 0")
    its = fresh(met, "_id", "_hash", "_unit", "_anchor")
    same = F.col("doc_id").eqNullSafe(F.col(its[0])) & (F.col("text_hash") == F.col(its[1])) & (F.col("unit") == F.col(its[2]))
    met = met.join(rarest.toDF(*its), same & (F.col("best") == F.col(its[3])), "left_semi")
    return met.select(*key, "label", "role", "size", "start", "n", (F.col("weight") / F.col("total")).alias("share"))


def licences(
    docs: DataFrame,
    base: tuple[Template, ...] = BASE,
    more: tuple[Template, ...] = MORE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each
    row of ``docs``.

    ``n_base`` counts the places where a phrase of ``base`` begins, ``first_word`` and
    ``last_word`` are the smallest and largest (words from 0, null without any). Labels are
    arrays, sorted: those of the phrases, and with those of ``more`` all. ``score`` is the
    largest share of a template that was found at one beginning, 0 to 1.

    Words are those between ASCII signs other than letters and digits, A-Z taken as a-z.
    Null and empty texts have none. Null ids and repeated rows are kept, rows of one id
    and different texts are told apart; further columns are not read. An empty table gives
    no rows.
    """
    index = postings(base, more)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    places = materialize(licence_words(rows, index), "licence-words")
    met = beginnings(places, index, places.count())
    whole = F.col("n") == F.col("size")
    is_base, is_key, is_notice = (F.col("role") == r for r in ("base", "key", "notice"))
    files = met.groupBy("doc_id", "text_hash").agg(
        F.count_if(is_base & whole).alias("n_base"),
        F.min(F.when(is_base & whole, F.col("start"))).alias("first_word"),
        F.max(F.when(is_base & whole, F.col("start"))).alias("last_word"),
        # sets of at most as many as there are templates
        F.collect_set(F.when(is_base & whole, F.col("label"))).alias("base"),
        F.collect_set(F.when(is_key & whole, F.col("unit"))).alias("keys"),
        F.collect_set(F.when(is_notice & (F.col("share") >= SHARE), F.col("unit"))).alias("notices"),
        F.max("share").alias("score"),
    )
    own = [F.lit(None).cast("string")]
    for t in more:
        held = F.array_contains("notices", f"notice:{t.text}")
        for k in t.keys or (t.text,):
            held = held & F.array_contains("keys", f"key:{k}")
        own.append(F.when(held, F.lit(t.label)))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.array_compact(F.array(*own)))))
    files = files.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n_base", "first_word", "last_word", F.array_sort("base").alias("base_labels"), labels.alias("labels"), "score")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    none = F.array().cast("array<string>")
    return places.drop("places").join(files, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", none).alias("base_labels"),
        F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def report(docs: DataFrame) -> DataFrame:
    found = licences(docs)
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def _report_sql() -> str:
    index = postings(BASE, MORE)
    values = ", ".join(f"('{p.word}', '{p.unit}', '{p.label}', '{p.role}', {p.at}, {p.size}, {'true' if p.rare else 'false'})" for p in index)
    needs = ", ".join(f"('notice:{t.text}', '{t.label}', 'key:{k}')" for t in MORE for k in t.keys or (t.text,))
    return rf"""
WITH postings(word, unit, label, role, place, size, rare) AS (VALUES {values}),
needs(notice, label, key) AS (VALUES {needs}),
docs AS (
  SELECT row_number() OVER () AS n, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SEPARATORS}'), lambda x: x <> '') AS words
  FROM documents),
places AS (
  SELECT * FROM (SELECT n, unnest(words) AS word, unnest(range(len(words))) AS pos FROM docs)
  WHERE word IN (SELECT word FROM postings)),
-- of rows that repeat id and text, all count for frequencies as one
frequency AS (
  SELECT word, count(DISTINCT (doc_id, words)) AS df FROM places JOIN docs USING (n) GROUP BY word),
weighted AS (
  SELECT p.*, CASE WHEN rare THEN 1 + CAST(floor(1000 * ln(((SELECT count(*) FROM docs) + 1) / (coalesce(df, 0) + 1))) AS BIGINT) ELSE 0 END AS weight
  FROM postings p LEFT JOIN frequency USING (word)),
totals AS (SELECT unit, sum(weight) AS total FROM weighted GROUP BY unit),
met AS (
  SELECT n, unit, label, role, size, pos - place AS start, count(*) AS k, sum(weight) AS weight, max((weight, word)) AS best
  FROM places JOIN weighted USING (word) GROUP BY ALL),
found AS (
  SELECT met.*, weight / total AS share FROM met JOIN totals USING (unit)
  QUALIFY best = max(best) OVER (PARTITION BY n, unit) AND max(best) OVER (PARTITION BY n, unit)[1] > 0),
files AS (
  SELECT n, count(*) FILTER (role = 'base' AND k = size) AS n_base, min(start) FILTER (role = 'base' AND k = size) AS first_word,
    max(start) FILTER (role = 'base' AND k = size) AS last_word, max(share) AS score FROM found GROUP BY n),
base AS (SELECT DISTINCT n, label FROM found WHERE role = 'base' AND k = size),
own AS (
  SELECT f.n, d.label FROM (SELECT DISTINCT n, unit FROM found WHERE role = 'notice' AND share >= {SHARE}) f JOIN needs d ON d.notice = f.unit
  LEFT JOIN (SELECT DISTINCT n, unit FROM found WHERE role = 'key' AND k = size) h ON h.n = f.n AND h.unit = d.key
  GROUP BY ALL HAVING count(*) = count(h.unit)),
marks AS (
  SELECT n, string_agg(label, ',' ORDER BY label) FILTER (known) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT n, label, true AS known FROM base UNION ALL SELECT n, label, false FROM own) GROUP BY n)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM docs LEFT JOIN files USING (n) LEFT JOIN marks USING (n)
"""


@register("op11_rare_words", _report_sql())
def op11_rare_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
