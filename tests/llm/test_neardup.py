import random

import numpy as np

from tablewright.llm import neardup
from tablewright.llm.components import components
from tests.llm.conftest import edge_rows


def sets(text, width):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < width else [tuple(w[i : i + width]) for i in range(len(w) - width + 1)])


def brute(rows, width):
    """{(id, text): (size, component, kept)}, pair by pair."""
    docs = sorted({(i, t) for i, t in rows}, key=str)
    found = [sets(t, width) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(docs)):
        for y in range(x):
            both = len(found[x] & found[y])
            if both and 100 * both >= 80 * (len(found[x]) + len(found[y]) - both):
                parent[root(x)] = root(y)
    out = {}
    for x, (i, t) in enumerate(docs):
        ids = [docs[y][0] for y in range(len(docs)) if root(y) == root(x) and docs[y][0] is not None]
        component = min(ids, default=None) if found[x] else i
        out[i, t] = (len(found[x]), component, i == component)
    return out


def test_against_pairs(spark, edge, nothing):
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = [(r[0], r[1]) for r in edge_rows()]
    for k in range(150):  # copies with 0 to 8 edits: links on both sides of the threshold
        words = list(base)
        for _ in range(rng.randint(0, 8)):
            words[rng.randrange(120)] = rng.choice(vocabulary)
        rows.append((1000 + k, " ".join(words)))
    rows += [(2000, "a b"), (2001, "A  B"), (2002, "a b c d e f g h"), (2003, "a b c d e f g h i")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 4)
    got = neardup.linked(df, width=4).collect()
    assert len(got) == len(want)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got), key=str) == sorted(((i, *v) for (i, _), v in want.items()), key=str)
    assert neardup.linked(nothing).isEmpty()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    borrow = neardup._borrowing(128)
    for n in (3, 40, 2000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[: int(0.9 * len(a))], rng.integers(0, 1 << 63, len(a) // 10 + 1).astype(np.uint64)]))
        same = (neardup.signature(a, 128, borrow) == neardup.signature(b, 128, borrow)).mean()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(same - true) < (0.35 if n < 10 else 0.2)
        assert set(neardup.signature(a, 128, borrow)) <= set(a)


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 200)]
    got = {r["a"]: r["b"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, 101: 100, 102: 100}


def test_links_that_no_centre_has(spark):
    """One group around the threshold, in families: members of a family are linked to each
    other, and hardly to the centre of their buckets. Cells of three members give the same."""
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(500)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    rows = []
    for k in range(300):
        words = list(base)
        for _ in range(rng.randint(4, 8)):
            words[rng.randrange(150)] = rng.choice(vocabulary)
        for _ in range(3):
            own = list(words)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(150)] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: v[1] for (i, _), v in brute(rows, 4).items()}
    assert 1 < len(set(want.values())) < len(rows)
    assert {r["doc_id"]: r["component_id"] for r in neardup.linked(df, width=4).collect()} == want
    assert {r["doc_id"]: r["component_id"] for r in neardup.linked(df, width=4, cell=3).collect()} == want


def test_prefixes_and_parities_lose_no_link():
    rng = np.random.default_rng(2)
    linked = 0
    for _ in range(2000):
        n = int(rng.integers(1, 60))
        whole = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        a, b = (np.sort(rng.choice(whole, max(1, len(whole) - int(rng.integers(0, 1 + len(whole) // 8))), replace=False)) for _ in range(2))
        centre = np.sort(rng.choice(whole, int(rng.integers(0, len(whole) + 1)), replace=False))
        both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        odd = int(np.bitwise_count((neardup.parities(a) ^ neardup.parities(b)).view(np.uint64)).sum())
        assert odd <= union - both
        if 100 * both >= 80 * union:
            linked += 1
            first, second = (neardup.prefix(x, np.setdiff1d(x, centre), 80) for x in (a, b))
            assert len(np.intersect1d(first, second))
            assert odd * 180 <= (len(a) + len(b)) * 20
    assert linked > 500


def test_copies_with_changes_of_their_own_are_hardly_compared(spark, monkeypatch):
    """Copies on both sides of the threshold, in one group: fewer pairs than members are
    compared besides those with centres, and a chain of three keeps its links."""
    rng = random.Random(12)
    base = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(200):
        words = list(base)
        for at in rng.sample(range(400), rng.randint(0, 20)):
            words[at] = f"d{k}-{at}"
        rows.append((k, " ".join(words)))
    for k in range(3):
        rows.append((200 + k, " ".join(base[:190] + [f"x{i}" for i in range(110)] + base[300:] + [f"y{k}"] * k)))
    counts, across = [], neardup._across

    def counted(*args):
        out = neardup.materialize(across(*args), "counted")
        counts.append(out.count())
        return out

    monkeypatch.setattr(neardup, "_across", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: v[1] for (i, _), v in brute(rows, 4).items()}
    assert {r["doc_id"]: r["component_id"] for r in neardup.linked(df, width=4).collect()} == want
    assert len(set(want.values())) > 20 and want[202] == 200
    assert counts[0] < len(rows)


def test_differences_from_a_centre_lose_no_link():
    rng = np.random.default_rng(5)
    checked = 0
    for _ in range(4000):
        whole = np.unique(rng.integers(0, 1 << 63, int(rng.integers(2, 80))).astype(np.uint64))
        pick = lambda: rng.choice(whole, int(rng.integers(max(1, len(whole) * 7 // 10), len(whole) + 1)), replace=False)
        centre, a, b = pick(), pick(), pick()
        da, db = np.setxor1d(a, centre), np.setxor1d(b, centre)
        least = neardup.excess(len(centre), 0, 80)
        of_a, of_b = neardup.excess(len(a), len(da), 80), neardup.excess(len(b), len(db), 80)
        assert least <= min(of_a, of_b)
        assert (of_a + least <= 0) == (100 * len(np.intersect1d(a, centre)) >= 80 * len(np.union1d(a, centre)))
        linked = 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
        assert linked == (2 * 180 * len(np.intersect1d(da, db)) >= of_a + of_b)
        if of_a + least > 0:
            checked += linked
            assert of_a + of_b > 0
    assert checked > 100
