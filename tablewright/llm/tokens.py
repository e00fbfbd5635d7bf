"""Tokenizers, and exact token counts at every prefix of a text."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from functools import cache, partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.common import map_rows, register, table, texts

# Entries of a task's memo before it is emptied; entries are short, so some tens of MB.
MEMO_ENTRIES = 500_000
MEMO_CHARS = 48
LIMIT = 4096


class Memo(dict):
    """Values by short text, made when first asked for, of bounded number."""

    def __init__(self, make: Callable):
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[key] = value
        return value


@cache
def byte_bpe_encoder(path: str | None = None, specials: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),)) -> Callable[[str], bytes]:
    """A function from text to ids, as little-endian unsigned 32-bit integers.

    The vocabulary is byte_bpe_50k in its form as ranks; ids are those that the tokenizers
    library gives for byte_bpe_50k.json without added special tokens (strings of special
    tokens inside a text are that token, the library's default).

    A space after something else than white space always begins a new piece, so a text
    without runs of white space around a space is encoded word by word, each distinct
    word once; other texts are encoded whole.
    """
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    model = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(specials))
    allowed = {s for s, _ in specials}

    def whole(text: str) -> bytes:
        return np.array(model.encode(text, allowed_special=allowed, disallowed_special=()), dtype="<u4").tobytes()

    memo = Memo(lambda word: whole(" " + word))
    run = re.compile(r"\s (?:\s|\Z)").search

    def encode(text: str) -> bytes:
        if run(text) or any(s in text for s in allowed):
            return whole(text)
        first, *rest = text.split(" ")
        return whole(first) + b"".join(map(memo.__getitem__, rest))

    return encode


_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), base)]), dtype=np.uint64)[:n]


def _codes(text: str) -> np.ndarray:
    """Code points plus one: none is zero, so that none leaves a hash as it is."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mixed = (hashes ^ (hashes >> np.uint64(29))) * _MIX
    return (mixed >> np.uint64(44)).astype(np.int64), ((mixed >> np.uint64(20)) & np.uint64((1 << 20) - 1)).astype(np.int64)


class PrefixCounter:
    """Token counts at every prefix of a text, for a sentencepiece BPE model with byte
    fallback, a dummy space in front and no normalization.

    A sequence of tokens is the encoding of a text exactly if each pair of neighbours is
    the encoding of its own text. So the last token of a prefix is the one token that ends
    there and goes together with the last token of the prefix before it, and its count is
    one more: one step over the tokens ending at each place, and nothing is encoded again.

    No token has a space behind another character, so a word with the spaces before it
    is encoded alone, and the counts inside a text are those of its words, added up.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        usual = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.rank = {model.id_to_piece(i).replace("▁", " "): -model.get_score(i) for i in usual}
        self.longest = max(map(len, self.rank))
        # tokens that can occur at all, by their last character: the lengths to try there
        self.tokens = {t for t in self.rank if len(t) == 1 or self._merge(t) == [t]}
        sizes: dict[str, set[int]] = {}
        for t in self.tokens:
            sizes.setdefault(t[-1], set()).add(len(t))
        self.sizes = {c: tuple(sorted({1, *v}, reverse=True)) for c, v in sizes.items()}
        self.sides = Memo(self._side)
        self.pairs: dict[str, Memo] = {}
        self.words = Memo(self._word)
        self.block = max(len(t) for t in self.rank if not t.strip(" "))
        self.rests = [len(self._merge(" " * n)) for n in range(self.block + 1)]
        self._index()

    def _merge(self, text: str) -> list[str]:
        """The encoding by its definition: the best neighbouring pair is merged, the
        leftmost of equals first."""
        parts = list(text)
        while len(parts) > 1:
            joined = [self.rank.get(a + b, np.inf) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(joined)
            if best == np.inf:
                break
            i = joined.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _side(self, token: str) -> tuple[list, list]:
        """The parts that stand at the left and at the right end of a token while it is
        merged, each with the rank of its own merge and of the merge that ends it."""
        parts, left, right, born = list(token), [], [], [-1.0, -1.0]
        while len(parts) > 1:
            joined = [self.rank.get(a + b, np.inf) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(joined)
            i = joined.index(best)
            if i == 0:
                left.append((parts[0], born[0], best))
                born[0] = best
            if i == len(joined) - 1:
                right.append((parts[-1], born[1], best))
                born[1] = best
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [*left, (token, born[0], np.inf)], [*right, (token, born[1], np.inf)]

    def _goes(self, left: str, right: str) -> bool:
        """Whether ``right`` behind ``left`` stays apart from it: no two parts that stand at
        the border at the same time are merged before one of them is merged inwards. Of
        equal ranks, the merge further left comes first."""
        for x, x_born, x_end in self.sides[left][1]:
            for y, y_born, y_end in self.sides[right][0]:
                rank = self.rank.get(x + y)
                if rank is not None:
                    at = max(rank, x_born, y_born)
                    if at < x_end and (at < y_end or at == rank == y_end):
                        return False
        return True

    def _cost(self, token: str) -> int:
        return 1 if token in self.rank else len(token.encode("utf-8", "surrogatepass"))

    def _steps(self, word: str) -> tuple[list[int], list[bool]]:
        """For each prefix of a word with one space in front: its count, and whether its
        first token is the space alone."""
        last, counts, alone = [""], [0], [False]
        tokens, pairs = self.tokens, self.pairs
        for end in range(1, len(word) + 1):
            for size in self.sizes.get(word[end - 1], (1,)):
                before = end - size
                if before < 0:
                    continue
                token = word[before:end]
                if size > 1 and token not in tokens:
                    continue
                if before:
                    of = pairs.get(last[before])
                    if of is None:
                        if len(pairs) >= MEMO_ENTRIES:
                            pairs.clear()
                        of = pairs[last[before]] = Memo(partial(self._goes, last[before]))
                    if not of[token]:
                        continue
                last.append(token)
                counts.append(counts[before] + self._cost(token))
                alone.append(alone[before] if before else token == " ")
                break
            else:
                raise ValueError(f"no token ends at {end} of {word!r}")
        return counts, alone

    def _word(self, word: str) -> bytes:
        """The changes of the count in a word with the spaces before it. Tokens of spaces have the
        lowest rank, all the same, so they are made last, from the left, out of the
        spaces that the word leaves."""
        tail = word.lstrip(" ")
        run = len(word) - len(tail)
        counts, alone = self._steps(" " + tail)
        if run > 1:
            with_last, without = self._spaces(run), self._spaces(run - 1)
            inside = [with_last + c - 1 if a else without + c for c, a in zip(counts[2:], alone[2:], strict=True)]
            counts = [*map(self._spaces, range(run + 1)), *inside]
        return np.array([b - a for a, b in zip(counts, counts[1:], strict=False)], dtype="<i2").tobytes()

    def _index(self) -> None:
        """Tables to find tokens by the hash of their text, for many places at once."""
        self.names = sorted(self.tokens)
        if not set("".join(self.names)) <= self.tokens:
            raise ValueError("a token has a character that is no token")
        n = len(self.names)
        self.hashes = np.zeros(n + 1, dtype=np.uint64)
        for i, name in enumerate(self.names):
            codes = _codes(name)
            self.hashes[i] = (codes * _powers(len(codes))).sum(dtype=np.uint64)
        if len(np.unique(self.hashes[:n])) != n:
            raise ValueError("two tokens have one hash")
        # two places for each token; the entry n stands for none
        self.slots = [np.full(1 << 20, n, dtype=np.int32) for _ in range(2)]
        for i in range(n):
            for table, at in zip(self.slots, _places(self.hashes[i : i + 1]), strict=True):
                if table[at[0]] == n:
                    table[at[0]] = i
                    break
            else:
                raise ValueError("the table of tokens is too small")
        self.pair_keys = np.full(1 << 21, -1, dtype=np.int64)
        self.pair_goes = np.zeros(1 << 21, dtype=bool)

    def _tokens_at(self, hashes: np.ndarray) -> np.ndarray:
        """The number of the token with each hash, or that of none."""
        none = len(self.names)
        first, second = _places(hashes)
        found = self.slots[0][first]
        found = np.where(self.hashes[found] == hashes, found, none)
        rest = np.flatnonzero(found == none)
        other = self.slots[1][second[rest]]
        found[rest] = np.where(self.hashes[other] == hashes[rest], other, none)
        return found

    def _all_go(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`_goes` for many pairs; answers are kept in a table of fixed size."""
        none = len(self.names)
        known = (left != none) & (right != none)  # what is no token is never merged
        keys = np.where(known, left.astype(np.int64) * (none + 1) + right, 0)
        at = ((keys.astype(np.uint64) * _MIX) >> np.uint64(43)).astype(np.int64)
        new = np.flatnonzero(self.pair_keys[at] != keys)
        out = self.pair_goes[at]
        if len(new):
            asked, back = np.unique(keys[new], return_inverse=True)
            goes = [self._goes(self.names[k // (none + 1)], self.names[k % (none + 1)]) for k in asked.tolist()]
            out[new] = np.array(goes)[back]
            self.pair_keys[at[new]], self.pair_goes[at[new]] = keys[new], out[new]
        return out | ~known

    def solve(self, words: list[str]) -> None:
        """The counts of :meth:`_word` for many words, each behind one space, place by
        place over all words at once."""
        words = sorted(words, key=len, reverse=True)
        sizes = np.array([len(w) + 1 for w in words])
        text = " " + " ".join(words)
        codes = _codes(text)
        n, none = len(codes), len(self.names)
        starts = np.cumsum(sizes) - sizes
        powers = _powers(n)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers, dtype=np.uint64)])
        back = _powers(n, _INVERSE)
        place = np.arange(n) - np.repeat(starts, sizes)
        last = np.full(n, none, dtype=np.int32)
        count = np.zeros(n, dtype=np.int32)
        candidates: list[np.ndarray | None] = [None]
        for size in range(1, self.longest + 1):
            ends = np.flatnonzero(place >= size - 1) if size > 1 else np.arange(n)
            found = np.full(n, none, dtype=np.int32)
            begins = ends + 1 - size
            found[ends] = self._tokens_at((total[ends + 1] - total[begins]) * back[begins])
            candidates.append(found)
        widths = np.ones(n, dtype=np.int32)
        strange = candidates[1] == none
        if strange.any():
            c = codes[strange] - np.uint64(1)
            widths[strange] = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
        for end in range(int(sizes[0])):
            open_ = starts[: np.searchsorted(-sizes, -end)] + end
            for size in range(min(self.longest, end + 1), 0, -1):
                if not len(open_):
                    break
                token = candidates[size][open_]
                at = np.flatnonzero(token != none) if size > 1 else np.arange(len(open_))
                if not len(at):
                    continue
                here, token = open_[at], token[at]
                if size <= end:
                    goes = self._all_go(last[here - size], token)
                    at, here, token = at[goes], here[goes], token[goes]
                    count[here] = count[here - size]
                last[here] = token
                count[here] += widths[here] if size == 1 else 1
                open_ = np.delete(open_, at)
            if len(open_):
                raise ValueError("no token ends at a place of a word")
        changes = np.diff(count, prepend=0)
        changes[starts] = count[starts]
        data, ends = changes.astype("<i2").tobytes(), 2 * (starts + sizes)
        cut = [data[a:b] for a, b in zip((2 * starts).tolist(), ends.tolist(), strict=True)]
        self.words.update(zip([" " + w for w in words], cut, strict=True))

    def _spaces(self, n: int) -> int:
        """The count of n spaces: blocks of the longest token, then the rest."""
        return n // self.block * self.rests[self.block] + self.rests[n % self.block]

    def words_of(self, text: str) -> list[str]:
        """The text in words, each with the spaces before it; the first has one more."""
        if not text:
            return []
        text = text.replace("▁", " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return re.findall(" +[^ ]*", " " + text)
        return (" " + text.replace(" ", "\0 ")).split("\0") if "\0" not in text else [" " + w for w in text.split(" ")]

    def learn(self, texts_: list[list[str]]) -> None:
        """Make the counts of all new words of usual length at once."""
        new = set().union(*texts_).difference(self.words)
        if len(self.words) + len(new) > MEMO_ENTRIES:
            self.words.clear()
            new = set().union(*texts_)
        usual = [w[1:] for w in new if len(w) <= MEMO_CHARS and w[1:2] != " "]
        if usual:
            self.solve(usual)

    def changes(self, words: list[str]) -> bytes:
        """The change of the count at each character, as 16-bit integers. The space in
        front is no character of the text: its count goes to the first one."""
        if not words:
            return b""
        found = b"".join(map(self.words.__getitem__, words))
        return np.frombuffer(found[:4], dtype="<i2").sum(keepdims=True, dtype="<i2").tobytes() + found[4:]


@cache
def prefix_counter(path: str | None = None) -> PrefixCounter:
    import public_tokenizers

    return PrefixCounter(path or public_tokenizers.path("piece_bpe_32k.model"))


def counts_of(prefixes: bytes) -> np.ndarray:
    """The token count at every prefix, from the empty one on, from stored changes."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(prefixes, dtype="<i2"), dtype=np.int64)])


def fit(prefixes: bytes, budget: int) -> int:
    """The characters of the longest prefix that has at most ``budget`` tokens."""
    return int(np.flatnonzero(counts_of(prefixes) <= budget)[-1])


def prefix_counts(
    docs: DataFrame,
    limit: int = LIMIT,
    keep_prefixes: bool = True,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars[, prefixes]) for each document.

    ``fit_chars`` is the length in code points of the longest prefix with at most
    ``limit`` tokens. ``prefixes`` has, for each code point, the change of the exact token
    count when it is added (:func:`counts_of`, :func:`fit`); :func:`budgets` answers
    questions from it without the texts. A count can fall when a character is added.

    Null text is empty: no bytes, no tokens. Null ids and repeated rows are kept, row by
    row. An empty table gives no rows. Further columns are not read.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    if keep_prefixes:
        schema += ", prefixes binary"

    def make():
        counter = prefix_counter(path)

        def step(doc_ids, values):
            out: list[list] = [[] for _ in range(5 + keep_prefixes)]
            split = [counter.words_of(value or "") for value in values]
            counter.learn(split)
            for doc_id, value, words in zip(doc_ids, values, split, strict=True):
                text = value or ""
                prefixes = counter.changes(words)
                n = int(np.frombuffer(prefixes, dtype="<i2").sum(dtype=np.int64))
                chars = fit(prefixes, limit) if n > limit else len(text)
                row = (doc_id, len(text.encode()), n, n > limit, chars, prefixes)
                for column, v in zip(out, row, strict=False):
                    column.append(v)
            return out

        return step

    return map_rows(texts(docs, id_col, text_col), make, schema)


def budgets(stored: DataFrame, budget: int) -> DataFrame:
    """(doc_id, n_tokens, fit_chars) for another budget, from stored prefixes alone."""

    def make():
        def step(doc_ids, totals, prefixes):
            return doc_ids, totals, [fit(p, budget) for p in prefixes]

        return step

    return map_rows(stored.select("doc_id", "n_tokens", "prefixes"), make, "doc_id long, n_tokens long, fit_chars long")


@register("op2_prefix_tokens")
def op2_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts(table(spark, sf_dir, "documents"), keep_prefixes=False)
