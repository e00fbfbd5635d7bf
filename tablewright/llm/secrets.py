"""Secret scans through an inverted index of trigrams, in DataFrame operations only.

From each rule's regular expression follows a Boolean query over lower-case trigrams that
every match must have: clauses that all hold, each a choice of sets of trigrams. Postings
are made for the trigrams that queries name. Intersecting them by document gives each
rule's candidates, and only these are read with its expression. Rules without a mandatory
trigram read every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants, _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import fresh, register, table
from tablewright.session import materialize

STRINGS = 64  # of a set of literal strings that is followed exactly
CLASS = 8  # characters of a class that is


@dataclass(frozen=True)
class Rule:
    """A match counts if the given group of it has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),  # runs of fewer characters would be dropped
)
MORE = (
    Rule("code_host", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("key_block", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("login_url", r"[a-z]{2,12}://[A-Za-z0-9._-]+:[^\x20\x09-\x0D/@]{3,}@[A-Za-z0-9.-]+"),
)

# What is replaced: for a key, the lines behind its header too. Up to the END line no dash
# may come but those of header fields; without an END line, the lines of base64 that follow.
# Groups repeat possessively and the rest are single classes: with other repeated groups the
# engine's stack grows with the text. Line ends may be written as escapes.
_FIELDS = r"(?:(?:\s|\\[nr])*+(?:Proc-Type|DEK-Info|Version|Comment): (?:[^\r\n\\]|\\(?![nr]))*+)*+"
_LINES = r"[A-Za-z0-9+/=\s\\]*(?<=[A-Za-z0-9+/=]{20})(?:[\r\n]+[\t ]*[A-Za-z0-9+/]+={0,2}[\t ]*(?![^\r\n]))?"
_KEY = rf"{_FIELDS}(?:[^-]*-----END [A-Z ]{{0,24}}PRIVATE KEY-----|{_LINES})"
WHOLE = tuple(Rule(r.kind, rf"{r.pattern}(?:{_KEY})?") if r.kind == "key_block" else r for r in BASE + MORE)

Alternatives = frozenset[frozenset[str]]


def _sequence(parsed) -> list[set[str] | None]:
    """What the parts of an expression match: a small set of lower-case strings, or None
    for anything."""
    out: list[set[str] | None] = []
    for op, argument in parsed:
        if op is _constants.LITERAL:
            out.append({chr(argument).lower()})
        elif op is _constants.IN:
            out.append(_class(argument))
        elif op is _constants.SUBPATTERN:
            out += _sequence(argument[-1])
        elif op is _constants.BRANCH:
            found = [_exact(_sequence(x)) for x in argument[1]]
            strings = None if None in found else set().union(*found)
            out.append(strings if strings and len(strings) <= STRINGS else None)
        elif op is _constants.MAX_REPEAT or op is _constants.MIN_REPEAT:
            least, most, inner = argument
            strings = _exact(_sequence(inner))
            if strings is None:
                out.append(None)
            elif (least, most) == (0, 1):
                out.append(strings | {""})
            else:
                out += [strings] * min(least, 16)
                if most != least or least > 16:
                    out.append(None)
        elif op is not _constants.AT:
            out.append(None)
    return out


def _class(members) -> set[str] | None:
    chars: set[str] = set()
    for op, argument in members:
        if op is _constants.LITERAL:
            chars.add(chr(argument).lower())
        elif op is _constants.RANGE and argument[1] - argument[0] < CLASS:
            chars |= {chr(c).lower() for c in range(argument[0], argument[1] + 1)}
        else:
            return None
    return chars if len(chars) <= CLASS else None


def _exact(parts: list[set[str] | None]) -> set[str] | None:
    strings = {""}
    for part in parts:
        if part is None or len(strings) * len(part) > STRINGS:
            return None
        strings = {a + b for a in strings for b in part}
    return strings


def trigram_query(pattern: str) -> frozenset[Alternatives]:
    """The clauses that hold for every text with a match; none if no trigram is mandatory."""
    runs, now = [], {""}
    for part in [*_sequence(_parser.parse(pattern)), None]:
        if part is not None and len(now) * len(part) <= STRINGS:
            now = {a + b for a in now for b in part}
        else:
            runs.append(now)
            now = part or {""}
    clauses = set()
    for strings in runs:
        if min(map(len, strings)) >= 3:
            sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
            clauses.add(frozenset(s for s in sets if not any(t < s for t in sets)))
    return frozenset(clauses)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id, text_hash): where each of the trigrams occurs, in any case."""
    low = rows.select("doc_id", "text_hash", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams)))
    return low.select(F.explode(found).alias("trigram"), "doc_id", "text_hash").distinct()


def candidates(index: DataFrame, queries: dict[str, frozenset[Alternatives]]) -> DataFrame:
    """(doc_id, text_hash, kinds): the rules whose query each document answers. Postings
    are intersected by counting, for each document and choice, the trigrams it has."""
    spark = index.sparkSession
    asked = [
        (t, kind, c, a, len(need))
        for kind, clauses in queries.items()
        for c, choices in enumerate(sorted(clauses, key=str))
        for a, need in enumerate(sorted(choices, key=str))
        for t in sorted(need)
    ]
    # a row for each trigram of a rule: its size is that of the rules
    asked = F.broadcast(spark.createDataFrame(asked, "trigram string, kind string, clause int, choice int, need long"))
    wanted = F.broadcast(spark.createDataFrame([(k, len(c)) for k, c in queries.items()], "kind string, clauses long"))
    key = ["doc_id", "text_hash"]
    whole = index.join(asked, "trigram").groupBy(*key, "kind", "clause", "choice", "need").agg(F.count("*").alias("has")).filter("has = need")
    held = whole.groupBy(*key, "kind").agg(F.count_distinct("clause").alias("held"))
    return held.join(wanted, "kind").filter("held = clauses").groupBy(*key).agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's matches, leftmost first and apart, as (start, rank, kind, end): between
    the pieces that the expression splits the text into."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    rows = F.arrays_zip(F.split(text, rule.pattern, -1).alias("piece"), whole.alias("whole"), group.alias("part"))
    rows = F.filter(rows, lambda x: x["whole"].isNotNull())
    kind = "struct<start:int,rank:int,kind:string,end:int,part:int>"
    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("found"))

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["piece"])
        end = start + F.length(x["whole"])
        row = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"), F.length(x["part"]).alias("part"))
        return F.struct(end.alias("at"), F.concat(done["found"], F.array(row)).alias("found"))

    found = F.aggregate(rows, first, step, lambda done: done["found"])
    found = F.filter(found, lambda x: x["part"] >= rule.least)
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["kind"].alias("kind"), x["end"].alias("end")))


SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, id_col: str = "doc_id", text_col: str = "text", column: str = "secrets") -> DataFrame:
    """``docs`` with a further ``column``: the spans (start, rank of the rule, kind, end) of
    all matches by start and rank, in code points, ends exclusive. Spans of different rules
    may overlap.

    Null text counts as empty. Null ids, repeated rows and further columns are kept. An
    empty table gives no rows.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    trigrams = sorted({t for q in indexed.values() for choices in q for need in choices for t in need})
    own_key, own_text, its_id, its_key, kinds = fresh(docs, "_key", "_text", "_its_id", "_its_key", "_kinds")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumn(own_key, F.xxhash64(text)).withColumn(own_text, text)
    if indexed:
        index = materialize(postings(_keyed(docs, id_col, text_col), trigrams), "postings")
        found = candidates(index, indexed).toDF(its_id, its_key, kinds)
        same = F.col(id_col).cast("long").eqNullSafe(F.col(its_id)) & (F.col(own_key) == F.col(its_key))
        rows = rows.join(found, same, "left")
    else:
        rows = rows.withColumn(kinds, F.lit(None).cast("array<string>"))
    none = F.array().cast(SPANS)
    each = []
    for rank, rule in enumerate(rules):
        spans = _spans(F.col(own_text), rule, rank)
        if rule.kind in indexed:
            spans = F.when(F.array_contains(kinds, rule.kind), spans).otherwise(none)
        each.append(spans)
    return rows.withColumn(column, F.array_sort(F.concat(*each))).select(*docs.columns, column)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for each row of ``docs``;
    as :func:`scanned`, null text is empty."""
    rows = scanned(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda x: x["rank"] < len(BASE))
    return rows.select(
        "doc_id",
        *(count(r.kind).alias(f"n_{r.kind}") for r in BASE),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("secrets")).alias("spans"),
    )


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each span replaced by ``mark``, overlapping spans by one, and the
    column ``length_col`` set to the new length. Private keys go with their body. Rows without a span, those with a null
    text among them, stay as they are."""
    (column,) = fresh(docs, "secrets")
    rows = scanned(docs, WHOLE, id_col=id_col, text_col=text_col, column=column)
    text = F.col(text_col)
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, x: Column) -> Column:
        before = F.substring(text, done["at"] + 1, x["start"] - done["at"])
        apart = x["start"] >= done["at"]
        return F.struct(
            F.greatest(done["at"], x["end"]).alias("at"),
            F.when(apart, F.concat(done["out"], before, F.lit(mark))).otherwise(done["out"]).alias("out"),
        )

    found = F.size(column) > 0
    changed = F.aggregate(column, first, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    out = rows.withColumn(text_col, F.when(found, changed).otherwise(text))
    if length_col:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(found, F.length(text_col).cast(kind)).otherwise(F.col(length_col)))
    return out.select(*docs.columns)


def _rule_sql(rule: Rule, rank: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
SELECT doc_id, n, {rank} AS rank, '{rule.kind}' AS kind, i,
  CAST(coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(w[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS start,
  length(w[i]) AS size
FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM (
  SELECT doc_id, n, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}', 0) AS w,
    regexp_extract_all(t, '{pattern}', {rule.group}) AS g FROM docs))
WHERE length(g[i]) >= {rule.least}"""


REPORT_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_rule_sql(r, k) for k, r in enumerate(BASE + MORE))}),
joined AS (SELECT n,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(concat_ws(':', kind, start, start + size), ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}) AS base,
    string_agg(concat_ws(':', kind, start, start + size), ',' ORDER BY start, rank) AS spans
  FROM found GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (n)
"""


@register("op5_trigram_secrets", REPORT_SQL)
def op5_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
