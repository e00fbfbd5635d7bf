import hashlib
import random

from pyspark.sql import functions as F

from tablewright.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "a\\<b\\\\>", "<<SYS>> x <</SYS>>", "<<ROLE user>> ", "[", "<", "\\", "", None, "日本\n\né", " <s> "]


def conversations(spark):
    rng = random.Random(6)
    rows = []
    for conv in [1, 2, 3, None]:
        for turn in range(12):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool <x>", None, "user"]), rng.choice(NASTY) if rng.random() < 0.8 else "long " * 300))
    rows += [(5, 0, "user", "same"), (5, 0, "user", "same"), (5, 0, "assistant", "tie"), (6, None, "assistant", "no turn")]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_round_trip(spark):
    rows, df = conversations(spark)
    messages = chat.numbered(df)
    log = chat.event_log(messages)
    shuffled = log.union(log.sample(0.3, seed=1)).orderBy(F.rand(3))
    assert sorted(map(str, chat.folded(shuffled).collect())) == sorted(map(str, messages.collect()))
    out = {r["conv_id"]: r for r in chat.read_back(chat.rendered(chat.folded(shuffled))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv))
        assert [(t["role"], t["text"]) for t in out[conv]["turns"]] == [(r, x) for _, r, x in own]
        assert out[conv]["loss_text"] == "".join(x for _, r, x in own if r == "assistant")


def test_loss_spans_are_assistant_texts_alone(spark):
    _, df = conversations(spark)
    for r in chat.rendered(chat.numbered(df)).collect():
        for s in r["loss"]:
            assert r["formatted"][: s["start"]].endswith("<s> ") and r["formatted"][s["end"] :].startswith(" </s>")


def test_folding(spark):
    events = [
        (1, 0, 5, "delta", None, "b"), (1, 0, 1, "open", "user", None), (1, 0, 2, "delta", None, "a"), (1, 0, 2, "delta", None, "a"),
        (1, 1, 1, "open", "assistant", None), (1, 1, 2, "delta", None, "draft"), (1, 1, 3, "regenerate", None, None), (1, 1, 4, "delta", None, "final"),
        (1, 2, 1, "open", "user", None), (1, 2, 2, "delta", None, "x"), (1, 2, 3, "edit", None, "new"), (1, 2, 4, "delta", None, "er"),
        (1, 3, 1, "delta", None, "no open"),
    ]
    df = spark.createDataFrame(events, "conv_id long, message long, seq long, kind string, role string, payload string")
    got = {r["message"]: (r["role"], r["text"]) for r in chat.folded(df).collect()}
    assert got == {0: ("user", "ab"), 1: ("assistant", "final"), 2: ("user", "newer"), 3: ("", "no open")}
    assert chat.digests(chat.rendered(chat.folded(df.limit(0)))).isEmpty()
