import os
import random
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import tokens
from tests.llm.conftest import edge_rows

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@cache
def loaded():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    return loaded()


@pytest.fixture(scope="module")
def counter():
    return tokens.prefix_counter()


TEXT = st.text(st.sampled_from("abcdefhinorst .,!?  \n\té日▁<>/s01A\x00'"), max_size=30)


@settings(max_examples=150, deadline=None)
@given(text=TEXT | st.text(max_size=20))
def test_every_prefix_has_the_librarys_count(text):
    library = loaded()
    counter = tokens.prefix_counter()
    words = counter.words_of(text)
    counter.learn([words])
    got = tokens.counts_of(counter.changes(words)).tolist()
    assert got == [len(library.encode(text[:i])) for i in range(len(text) + 1)]


def test_runs_of_spaces(library, counter):
    for n in [*range(1, 70), 500]:
        assert tokens.counts_of(counter.changes(counter.words_of(" " * n)))[-1] == len(library.encode(" " * n))


def test_many_words_at_once_are_as_one_by_one(counter):
    rng = random.Random(2)
    words = {"".join(rng.choice("abcdeést日.!") for _ in range(rng.randint(1, 12))) for _ in range(2000)}
    counter.words.clear()
    counter.solve(sorted(words))
    for w in words:
        assert counter.words[" " + w] == counter._word(" " + w)


def test_documents(spark, edge, nothing, library):
    got = tokens.prefix_counts(edge, limit=100).collect()
    assert len(got) == edge.count()
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or ""))) for i, t, *_ in edge_rows())
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in got)
    for r in got:
        assert tokens.fit(r["prefixes"], 100) == r["fit_chars"] and tokens.counts_of(r["prefixes"])[r["fit_chars"]] <= 100
    assert tokens.prefix_counts(nothing).isEmpty()


def test_budgets_need_no_text(spark, edge):
    stored = tokens.prefix_counts(edge)
    text = {r["doc_id"]: r["text"] for r in edge.where("doc_id in (1, 2)").collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in tokens.budgets(stored.where("doc_id in (1, 2)"), 50).collect():
        longest = max(i for i in range(len(text[r["doc_id"]]) + 1) if len(library.encode(text[r["doc_id"]][:i])) <= 50)
        assert r["fit_chars"] == longest


@settings(max_examples=200, deadline=None)
@given(text=st.text(st.sampled_from("abc  \n\t'sé日1.!<|endoftext|>  "), max_size=40) | st.text(max_size=30))
def test_byte_bpe_has_the_librarys_ids(text):
    from tokenizers import Tokenizer

    if not hasattr(test_byte_bpe_has_the_librarys_ids, "t"):
        test_byte_bpe_has_the_librarys_ids.t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = test_byte_bpe_has_the_librarys_ids.t.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokens.byte_bpe_encoder()(text), dtype="<u4").tolist() == want
    special = "a <|endoftext|> b" + text
    want = test_byte_bpe_has_the_librarys_ids.t.encode(special, add_special_tokens=False).ids
    assert np.frombuffer(tokens.byte_bpe_encoder()(special), dtype="<u4").tolist() == want
