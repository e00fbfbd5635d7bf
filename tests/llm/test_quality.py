import random

import numpy as np

from tablewright.llm import quality
from tests.llm.conftest import edge_rows


def base(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    seen, inside = {}, [False] * len(words)
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            for i in places:
                inside[i] = inside[i + 1] = inside[i + 2] = True
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    n, repeated = len(words), sum(inside)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), repeated, n < 50 or 100 * repeated > 50 * n


def test_base_statistics(edge, nothing):
    got = quality.verdicts(edge).collect()
    want = sorted((str(i), *base(t)) for i, t, *_ in edge_rows())
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r["doc_id"]), *(r[c] for c in columns)) for r in got) == want
    assert not any(r["kept"] for r in got if r["base_failed"])
    by = {r["doc_id"]: r for r in got}
    assert all(by[k]["kept"] for k in range(40)) and not by[112]["kept"]
    assert quality.verdicts(nothing).isEmpty()


def test_windows_of_many_distinct_words():
    rng = random.Random(5)
    words = [b"%d" % rng.randrange(60) for _ in range(4000)]
    assert quality.repeated_words(words) == base(b" ".join(words).decode())[4]


def test_estimates_do_not_follow_outliers(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(0.5, 0.1, (1500, quality.P))
    bad = rng.normal(3.0, 0.1, (300, quality.P))
    rows = [("g", *[int(v * quality.UNIT) for v in x]) for x in np.vstack([good, bad])]
    schema = "key string, " + ", ".join(f"{d} long" for d in quality.DIMENSIONS)
    found = quality.mcd(spark.createDataFrame(rows, schema)).first()
    for i in range(quality.P):
        assert abs(found[f"m{i}"] - 0.5) < 0.02
        assert 0.006 < found[f"c{i}_{i}"] < 0.016


def test_chi_squared():
    assert abs(quality.chi2_tail_quantile(0.05, 6) - 12.5916) < 1e-3
    assert abs(quality.chi2_cdf(12.5916, 6) - 0.95) < 1e-4
