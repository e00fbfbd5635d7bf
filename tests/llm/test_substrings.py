import hashlib
import random

import numpy as np
import pytest

from tablewright.llm import sentences, suffixes
from tests.llm.conftest import edge_rows


def covered(rows):
    """Every byte by brute force."""
    first = {}
    data = [(suffixes.LAST if i is None else i, i, (t or "").encode()) for i, t in rows]
    for order, _, b in data:
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(first.get(b[k : k + 50], order), order)
    out = []
    for order, i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < order:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_with_repeats():
    rng = random.Random(3)
    rows = [(r[0], r[1]) for r in edge_rows() if len(r[1] or "") < 40000]
    parts = ["".join(rng.choice("ab ") for _ in range(300)) for _ in range(4)]
    for k in range(50):
        part, at = rng.choice(parts), rng.randrange(250)
        text = "".join(rng.choice("xyzé") for _ in range(rng.randint(0, 80))) + part[at : at + rng.randint(40, 60)]
        rows.append((5000 + k, text + rng.choice(parts)[: rng.randint(0, 120)] + rng.choice(["", "ab" * 60, " " * 200])))
    return rows + [(6003, "a" * 49), (6004, "a" * 50), (6005, "a" * 51), (None, parts[0])]


@pytest.mark.parametrize("hot", [suffixes.HOT, 3])
def test_bytes_against_brute_force(spark, nothing, hot):
    rows = rows_with_repeats()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffixes.deduplicated(df, keep_text=True, hot=hot).collect()
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == covered(rows)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)
    assert suffixes.deduplicated(nothing).isEmpty()


def test_columns_are_in_suffix_order():
    rng = random.Random(8)
    anchor = "0123456789abcdef"
    strings, offsets = [], []
    for _ in range(60):
        left, right = rng.randint(0, 34), rng.randint(0, 34)
        strings.append(("".join(rng.choice("xy") for _ in range(left)) + anchor + "".join(rng.choice("xy") for _ in range(right))).encode())
        offsets.append(left)
    for r, order, common in suffixes.collection(strings, np.array(offsets)):
        rest = [strings[i][offsets[i] - r :] if offsets[i] >= r else None for i in order]
        shown = [x for x in rest if x is not None]
        assert shown == sorted(shown, key=lambda b: [*b, 256])
        for a, b, c in zip(rest, rest[1:], common[1:]):
            if a is not None and b is not None:
                same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                assert c == min(same, 50)


def test_sentences_against_brute_force(spark, nothing):
    rows = [(r[0], r[1]) for r in edge_rows()]
    rows += [(6001, "one. two. three."), (6002, "One.  two.\nthree. four"), (6003, "x " * 200), (6004, "y. " + "x " * 200), (6005, "a. b. c. a. b. c. d. ")]
    docs = sorted({(sentences.LAST if i is None else i, t or "", i) for i, t in rows}, key=lambda x: (x[0], x[1]))
    first = {}
    split = {}
    for order, text, _ in docs:
        starts, hashes = sentences.sentences(text)
        split[order, text] = starts, [h.tobytes() for h in hashes]
        for k in range(len(hashes) - 2):
            run = tuple(split[order, text][1][k : k + 3])
            first[run] = min(first.get(run, order), order)
    want = []
    for order, text, i in docs:
        starts, hashes = split[order, text]
        gone = [False] * len(hashes)
        for k in range(len(hashes) - 2):
            if first[tuple(hashes[k : k + 3])] < order or any(hashes[j : j + 3] == hashes[k : k + 3] for j in range(k)):
                gone[k] = gone[k + 1] = gone[k + 2] = True
        edges = [*starts, len(text)]
        kept = "".join(text[a:b] for a, b, g in zip(edges, edges[1:], gone) if not g) if starts else text
        want.append((i, len(hashes), sum(gone), kept))
    got = sentences.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    columns = ("doc_id", "n_sentences", "n_removed", "kept")
    assert len(got) == len(want)
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == sorted(want, key=str)
    assert sentences.without_repeats(nothing).isEmpty()


def test_passages_at_any_offset_of_a_long_line(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    prose = lambda n: [word() for _ in range(n)]
    for passage in [*(prose(50) for _ in range(300)), ["on", "off"] * 25, ["a", "b", "c"] * 17, ["x"] * 50]:
        found = []
        for before, after in ((5, 40), (17, 3), (0, 9), (30, 0)):
            words = prose(before) + passage + prose(after)
            cuts = sentences.pieces(words)
            edges = [cuts[k : k + 4] for k in range(len(cuts) - 3) if cuts[k] >= before and cuts[k + 3] <= before + len(passage)]
            found.append({tuple(tuple(words[a:b]) for a, b in zip(e, e[1:])) for e in edges})
        assert set.intersection(*found)
    passage = prose(200)
    rows = [(k, " ".join(prose(5 + 12 * k) + passage + prose(7 * k))) for k in range(4)]
    rows += [(10, " ".join(passage[:51])), (11, " ".join(passage[:51] + prose(30)))]
    got = {r["doc_id"]: r for r in sentences.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0]["n_removed"] == 0
    middle = passage[20:180]
    assert all(not set(middle) & set(got[k]["kept"].split()) for k in (1, 2, 3))
    assert all(not set(passage[20:30]) & set(got[k]["kept"].split()) for k in (10, 11))


def test_sentences_are_cut_once(spark, monkeypatch):
    """Runs and where sentences begin are kept: no text is cut again for a later pass."""
    rng = random.Random(8)
    rows = [(k, "\n".join(f"line {rng.randrange(6)} of it" for _ in range(12))) for k in range(40)] + [(None, "a. b. c. d."), (3, None)]
    calls, cut = [], sentences._cut
    monkeypatch.setattr(sentences, "_cut", lambda docs: calls.append(docs) or cut(docs))
    out = sentences.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows) and len(calls) == 1
    assert sum(r["n_removed"] for r in out) > 100
