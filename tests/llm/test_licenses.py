import math
import random
import re

from tablewright.llm import licenses
from tests.llm.conftest import edge_rows

TEXTS = [
    "Released under the MIT License. mit-license MIT\nlicense",
    "Licensed under CC BY-NC 4.0. CC-BY CC by cc. by",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); the apache_license",
    "GNU General Public Licence; GNU General Public License version 2 or 3",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "a version 2 by the gnu of public domain charge; GNU Lesser General Public License",
    "mitKicense K mit licenſe MITé License été mit lÎcense",
    "mit " * 500 + "license",
    "by by by of and 3 2 version",
    "",
    None,
]


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows):
    units = {("base", t.text): t.label for t in licenses.BASE} | {("key", k): "" for t in licenses.MORE for k in t.keys} | {("notice", t.text): t.label for t in licenses.MORE}
    every = {w for _, text in units for w in text.split()} - licenses.COMMON
    docs = {(i, t or ""): words_of(t) for i, t in rows}
    df = {w: sum(w in d for d in docs.values()) for w in every}
    weight = {w: 1 + math.floor(1000 * math.log((len(rows) + 1) / (df[w] + 1))) for w in every}
    out = []
    for doc_id, text in rows:
        words = docs[doc_id, text or ""]
        starts, base, keys, notices, score = [], set(), set(), set(), 0.0
        for (role, unit), label in units.items():
            unit = unit.split()
            mine = {w for w in words if w in unit and w in weight}
            if not mine:
                continue
            best = max(mine, key=lambda w: (weight[w], w))
            total = sum(weight.get(w, 0) for w in unit)
            beginnings = {i - k for i, w in enumerate(words) for k, u in enumerate(unit) if w == u == best}
            for s in sorted(beginnings):
                met = [w for k, w in enumerate(unit) if 0 <= s + k < len(words) and words[s + k] == w]
                share = sum(weight.get(w, 0) for w in met) / total
                score = max(score, share)
                if len(met) == len(unit) and role == "base":
                    starts.append(s)
                    base.add(label)
                if len(met) == len(unit) and role == "key":
                    keys.add(" ".join(unit))
                if role == "notice" and share >= 0.5:
                    notices.add(label)
        own = {t.label for t in licenses.MORE if t.label in notices and all(k in keys for k in t.keys)}
        out.append((doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)), score))
    return out


def plain(text):
    """Places of the phrases, word by word."""
    words = words_of(text)
    return sorted(i for t in licenses.BASE for i in range(len(words)) if words[i : i + len(t.text.split())] == t.text.split())


def test_labels(spark):
    rows = [*enumerate(TEXTS), (None, TEXTS[0]), (0, TEXTS[0]), (0, TEXTS[2])]
    got = [tuple(r) for r in licenses.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    by = {r[0]: r for r in got if r[0]}
    assert by[1][5:7] == ("cc-by", "cc-by,cc-by-nc") and by[1][2] == 4
    assert by[2][6] == "gpl,gpl-3.0" and by[3][6] == "apache,apache-2.0" and by[5][6] == "mit-notice" and by[6][6] == "bsd"
    assert by[4][2:5] == (1, 4, 4) and by[7][6] == "lgpl" and by[8][2] == 0
    assert by[9][2:5] == (1, 499, 499)
    assert by[10][2:] == (0, None, None, "", "", 0.0)


def test_base_places_word_by_word(spark):
    rng = random.Random(12)
    vocabulary = "gnu general public license apache cc by mit the of version 2 nc word licensed under".split()
    rows = [(k, "".join(rng.choice(vocabulary).upper() + rng.choice([" ", "-", "\n"]) for _ in range(rng.randint(0, 90)))) for k in range(200)]
    got = {r["doc_id"]: r for r in licenses.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, text in rows:
        found = plain(text)
        assert (got[k]["n_base"], got[k]["first_word"], got[k]["last_word"]) == (len(found), *((found[0], found[-1]) if found else (None, None)))
        assert 0 <= got[k]["score"] <= 1 and (not found or got[k]["score"] == 1)


def test_edges(spark, edge, nothing):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = [tuple(r) for r in licenses.report(edge).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    assert licenses.report(nothing).isEmpty()
    long = spark.createDataFrame([(1, "some words " * 200_000 + "CC by"), (2, "license " * 100_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.report(long).collect()}
    assert got[1]["first_word"] == 400_000 and got[2]["n_base"] == 0


def test_no_python_in_the_plan(edge):
    plan = licenses.report(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan and "ExistingRDD" not in plan


def test_common_words_stand_next_to_rare_ones():
    assert licenses.reach(licenses.postings(licenses.BASE, licenses.MORE)) <= 3
