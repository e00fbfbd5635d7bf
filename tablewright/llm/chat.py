r"""Event-sourced conversations: folded from an event log, rendered with a chat template,
and read back.

An event has (conv_id, message, seq, kind, role, payload). Events of a message are folded
in order of ``seq``: ``open`` sets the role and empties the text, ``delta`` adds its
payload, ``edit`` replaces the text by its payload, ``regenerate`` empties it for new
deltas. So a message's text is what came with its last ``open``, ``edit`` or
``regenerate``, and all deltas behind that.

The template marks turns::

    user       [INST] ... [/INST]
    assistant  <s> ... </s>
    system     <<SYS>> ... <</SYS>>
    others     <<ROLE name>> ... <</ROLE>>

Inside texts and names, each of ``< > [ \`` gets a backslash behind it. Every mark has
one of the first three without one, so no text can look like a mark, and dropping the
backslashes gives the text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tablewright.llm.common import register, table

CHUNK = 240  # code points of a streamed delta

MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}
OTHER = ("<<ROLE ", ">> ", " <</ROLE>>")
TURN = r"(?s)(\[INST\] |<s> |<<SYS>> |<<ROLE .*?>> )(.*?)(?: \[/INST\]| </s>| <</SYS>>| <</ROLE>>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<>\[\\])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<>\[\\])\\", "$1")


def numbered(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, message, role, text): turns numbered from 0 in each conversation. Rows of
    one turn number follow each other by role and text; repeated rows are turns of their
    own; null turn numbers come first. Null text and roles are empty."""
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("message"), "role", "text")


def event_log(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The log that streaming these (conv_id, message, role, text) leaves: text arrives in
    deltas of ``chunk`` code points; of some messages, by a hash of their key, a first
    draft is given up and regenerated, and of some the text is corrected by an edit."""
    key = F.xxhash64("conv_id", "message")
    event = lambda kind, role, payload: F.struct(F.lit(kind).alias("kind"), role.cast("string").alias("role"), payload.cast("string").alias("payload"))
    none = F.lit(None)
    deltas = lambda text: F.transform(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0)), lambda p: event("delta", none, p))
    empty = F.array().cast("array<struct<kind:string,role:string,payload:string>>")
    draft = F.when(F.pmod(key, F.lit(3)) == 0, F.concat(deltas(F.reverse("text")), F.array(event("regenerate", none, none)))).otherwise(empty)
    edit = F.when(F.pmod(key, F.lit(5)) == 0, F.concat(deltas(F.upper("text")), F.array(event("edit", none, F.col("text"))))).otherwise(deltas(F.col("text")))
    events = F.concat(F.array(event("open", F.col("role"), none)), draft, edit)
    return messages.select("conv_id", "message", F.posexplode(events).alias("at", "e")).select("conv_id", "message", (F.col("message").cast("long") * (1 << 32) + F.col("at")).alias("seq"), "e.kind", "e.role", "e.payload")


def folded(log: DataFrame) -> DataFrame:
    """(conv_id, message, role, text) from events in any order.

    An event that was delivered several times counts once. Different events with one
    ``seq`` are taken in the order open, regenerate, edit, delta, payload. Null payloads are
    empty; a message without ``open`` has an empty role. Null conv_ids are a conversation.
    """
    rank = F.when(F.col("kind") == "open", 0).when(F.col("kind") == "regenerate", 1).when(F.col("kind") == "edit", 2).otherwise(3)
    event = F.struct("seq", rank.alias("rank"), F.coalesce("payload", F.lit("")).alias("payload"), F.coalesce("role", F.lit("")).alias("role"))
    # events of one message only come together, each once
    events = F.array_sort(F.collect_set(event)).alias("events")
    base = F.max(F.when(rank < 3, F.struct("seq", rank.alias("rank")))).alias("base")
    role = F.max(F.when(rank == 0, F.struct("seq", F.coalesce("role", F.lit("")).alias("role"))))["role"]
    rows = log.groupBy("conv_id", "message").agg(events, base, F.coalesce(role, F.lit("")).alias("role"))
    kept = F.filter("events", lambda e: F.col("base").isNull() | (F.struct(e["seq"], e["rank"]) >= F.struct(F.col("base.seq"), F.col("base.rank"))))
    payload = F.transform(kept, lambda e: F.when(e["rank"] >= 2, e["payload"]).otherwise(""))
    return rows.select("conv_id", "message", "role", F.array_join(payload, "").alias("text"))


def rendered(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): each conversation's text, and the spans (start, end) of
    assistant texts in it, in code points, ends exclusive."""
    role, body = F.col("role"), escaped(F.col("text"))
    opening, closing = F.concat(F.lit(OTHER[0]), escaped(role), F.lit(OTHER[1])), F.lit(OTHER[2])
    for name, (before, after) in MARKS.items():
        opening = F.when(role == name, F.lit(before)).otherwise(opening)
        closing = F.when(role == name, F.lit(after)).otherwise(closing)
    parts = messages.select("conv_id", "message", (role == "assistant").alias("loss"), opening.alias("opening"), body.alias("body"), closing.alias("closing"))
    by = Window.partitionBy("conv_id").orderBy("message")
    whole = F.concat("opening", "body", "closing")
    before = F.coalesce(F.sum(F.length(whole)).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = parts.select("conv_id", "message", "loss", whole.alias("part"), (before + F.length("opening")).alias("start"), F.length("body").alias("size"))
    piece = F.struct("message", "part")
    span = F.when(F.col("loss"), F.struct("start", (F.col("start") + F.col("size")).alias("end")))
    grouped = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.array_sort(F.collect_list(span)).alias("loss"))
    return grouped.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["part"]), "").alias("formatted"), "loss")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text) from (conv_id, formatted, loss): turns as (role, text)
    by their marks, and the text under the loss spans, both unescaped."""
    marks = F.regexp_extract_all("formatted", F.lit(TURN), F.lit(1))
    bodies = F.regexp_extract_all("formatted", F.lit(TURN), F.lit(2))
    size = len(OTHER[0]), len(OTHER[1])

    def role(mark: Column) -> Column:
        name = unescaped(F.substring(mark, F.lit(size[0] + 1), F.length(mark) - sum(size)))
        for known, (before, _) in MARKS.items():
            name = F.when(mark == before, F.lit(known)).otherwise(name)
        return name

    turns = F.zip_with(marks, bodies, lambda m, b: F.struct(role(m).alias("role"), unescaped(b).alias("text")))
    under = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("conv_id", turns.alias("turns"), F.array_join(under, "").alias("loss_text"), "formatted")


def digests(formatted: DataFrame) -> DataFrame:
    rows = read_back(formatted)
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


PROBE = "</s>[INST] ok [/INST]"

DIGEST_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(regexp_replace(text, '([<>\[\\])', '\1\\', 'g')) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17
    ELSE 20 + length(regexp_replace(role, '([<>\[\\])', '\1\\', 'g')) END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@register("op6_chat_events", DIGEST_SQL)
def op6_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return digests(rendered(folded(event_log(numbered(rows)))))
