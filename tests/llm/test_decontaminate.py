import random

import numpy as np

from tablewright.llm import decontaminate


def score(a, b):
    """Smith and Waterman, cell by cell."""
    best, table = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
            best = max(best, table[i][j])
    return best


def test_alignment_cell_by_cell():
    rng = random.Random(2)
    pairs = [([rng.randint(3, 9) for _ in range(rng.randint(1, 12))], [rng.randint(3, 9) for _ in range(rng.randint(1, 30))]) for _ in range(60)]
    best, end = decontaminate.align([np.array(a, np.uint64) for a, _ in pairs], [np.array(b, np.uint64) for _, b in pairs])
    for (a, b), s, e in zip(pairs, best, end):
        assert s == score(a, b) == max((score(a, b[:k]) for k in range(e + 1)), default=0)


def tables(spark):
    rng = random.Random(7)
    vocabulary = ["of", "the", "and", "to"] * 40 + [f"w{k}" for k in range(400)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(prose(rng.randint(15, 45)))) for k in range(12)] + [(90, None), (91, ""), (92, "two words"), (None, " ".join(prose(20)))]
    docs = []
    for k in range(80):
        words = prose(rng.randint(30, 300))
        if k % 4 == 0:  # a copy of an item, edited more or less
            copy = items[k % 12][1].split()
            for _ in range(k % 7):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            at = rng.randrange(len(words))
            words[at:at] = [w.upper() + "," if k % 8 == 0 else w for w in copy]
        docs.append((k, " ".join(words)))
    docs += [(200, None), (201, ""), (202, "|| --"), (None, items[3][1]), (0, docs[0][1])]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_against_all_pairs(spark, nothing):
    docs, items, left, right = tables(spark)
    words = decontaminate._words()
    want = set()
    for i, t in set(docs):
        for k, x in items:
            a, b = words.of(x).tolist(), words.of(t).tolist()
            if len(a) >= decontaminate.SEED and score(a, b) / len(a) >= 0.4:
                want.add((i, k, round(score(a, b) / len(a), 4)))
    got = {(r["doc_id"], r["item_id"], r["score"]) for r in decontaminate.contaminated(left, right).collect()}
    assert got == want and len(want) >= 15
    assert decontaminate.contaminated(nothing, right).isEmpty()
    assert decontaminate.contaminated(left, right.limit(0)).isEmpty()


def test_edited_copies_in_many_documents(spark):
    """Edited so that few n-grams are left, each in as many documents as there are copies."""
    item = [f"i{k}" for k in range(30)]
    edited = [f"x{k}" if k % 4 == 3 else w for k, w in enumerate(item)]
    docs = [(k, " ".join([f"a{k}n{j}" for j in range(40)] + edited + [f"b{k}n{j}" for j in range(40)])) for k in range(12)]
    docs += [(50, " ".join(item)), (51, " ".join(item[:13])), (52, " ".join(item[:11]))]
    # spread over more words than the item has
    spread = item[:3] + [w for k in range(3, 30) for w in ([f"y{k}"] if k % 2 else []) + [item[k]]]
    docs += [(53, " ".join(spread))]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {r["doc_id"]: r["score"] for r in found} == {**{k: 0.5333 for k in range(12)}, 50: 1.0, 51: 0.4333, 53: 0.5333}


def test_frequent_words_make_no_pairs(spark):
    """One trigram stands in every document and every item."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    items = [(k, " ".join([word() for _ in range(12)] + ["one", "of", "the"] + [word() for _ in range(12)])) for k in range(100)]
    docs = [(k, " ".join([word() for _ in range(20)] + ["one", "of", "the"] + [word() for _ in range(20)])) for k in range(400)]
    docs += [(1000 + k, items[k][1]) for k in range(5)]
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.candidates(left, right).count() == 5
    assert {(r["doc_id"], r["item_id"], r["score"]) for r in decontaminate.contaminated(left, right).collect()} == {(1000 + k, k, 1.0) for k in range(5)}


def test_what_can_be_spared_by_trying():
    """Of an item's n-grams, no allowed edit leaves fewer than one more than are spared."""
    for n in range(3, 41):
        least = n
        for agree in range(1, n + 1):
            for errors in range(agree // 3 + 1):
                if agree - errors >= decontaminate.SCORE * n:
                    # stretches as even as they can be
                    lengths = [(agree + k) // (errors + 1) for k in range(errors + 1)]
                    least = min(least, sum(max(x - decontaminate.SEED + 1, 0) for x in lengths))
        assert decontaminate.spared(n) <= max(least - 1, 0)


def edited(rng, words, rate):
    out = []
    for w in words:
        kind = rng.random()
        if kind < rate / 3:
            continue
        out.append(f"z{rng.randrange(500)}" if kind < 2 * rate / 3 else w)
        if 2 * rate / 3 <= kind < rate:
            out.append(f"z{rng.randrange(500)}")
    return out


def test_recall_of_edited_copies(spark):
    """Against all pairs: all of those with few edits, and nine in ten of the rest."""
    rng = random.Random(5)
    items = [(k, [rng.choice(["of", "the", "and", "to", "in"]) if rng.random() < 0.4 else f"w{rng.randrange(300)}" for _ in range(rng.randint(12, 45))]) for k in range(20)]
    docs = []
    for k in range(240):
        filler = [f"f{rng.randrange(2000)}" if rng.random() < 0.6 else rng.choice(["of", "the", "and", "to", "in"]) for _ in range(80)]
        at = rng.randrange(80)
        copy = items[k % 20][1]
        docs.append((k, filler[:at] + edited(rng, copy, (0.1, 0.3, 0.5)[k % 3]) + filler[at:]))
    # a word put in after every second one leaves no trigram as it is
    spread = [x for j, w in enumerate(items[0][1]) for x in ([w, f"y{j}"] if j % 2 else [w])]
    docs.append((900, spread))
    words = decontaminate._words()
    want = {}
    for i, t in docs:
        for k, x in items:
            value = score(words.of(" ".join(x)).tolist(), words.of(" ".join(t)).tolist()) / len(x)
            if value >= decontaminate.SCORE:
                want[i, k] = round(value, 4)
    left = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string")
    right = spark.createDataFrame([(k, " ".join(x)) for k, x in items], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.contaminated(left, right).collect()}
    assert got.items() <= want.items()
    assert len(got) >= 0.95 * len(want) and len(want) > 150 and (900, 0) in got
    assert all(pair in got for pair in want if pair[0] % 3 == 0 and pair[0] % 20 == pair[1] and pair[0] < 900)


def test_long_texts_further_columns_and_items_of_one_id(spark):
    rng = random.Random(8)
    prose = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    first, second = prose(25), prose(30)
    long = prose(120_000)
    long[70_000:70_000] = second
    docs = spark.createDataFrame([(1, " ".join(long), 5, "s"), (2, " ".join(first), 6, "w"), (3, "v" * 200_000, 7, "p")], "doc_id long, text string, n long, seeds string")
    items = spark.createDataFrame([(4, " ".join(first), 1, "w"), (4, " ".join(second), 2, "x"), (None, " ".join(second), 3, "y"), (None, " ".join(first), 3, "y"), (5, " ".join(prose(9000)), 1, "z")], "item_id long, text string, item long, words string")
    got = {(r["doc_id"], r["item_id"], r["score"], r["start_word"], r["end_word"]) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(d, i, 1.0, *at) for d, at in ((1, (70_000, 70_030)), (2, (0, 25))) for i in (4, None)}


def test_shapes_of_n_grams():
    words = np.arange(3, 12, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    row, last_apart, first_apart = decontaminate._shaped(words)
    assert (row == decontaminate.runs(words, 3)).all()
    for k in range(len(words) - 3):
        assert last_apart[k] == decontaminate.runs(words[[k, k + 1, k + 3]], 3)[0]
        assert first_apart[k] == decontaminate.runs(words[[k, k + 2, k + 3]], 3)[0]
    assert len(last_apart) == len(first_apart) == len(words) - 3
    for n in range(3):
        assert not any(map(len, decontaminate._shaped(words[:n])))
