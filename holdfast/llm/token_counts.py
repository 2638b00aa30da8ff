"""Exact token counts at every prefix of a text, by dynamic programming over prefixes."""

from __future__ import annotations

import array
import bisect
import functools
import unicodedata
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.batches import annotate
from holdfast.llm.rows import documents
from holdfast.llm.tokens import CACHE, END, LONGEST, SPACED, WordCoder

LIMIT = 2048
SHORT = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}  # fixed values: split off as words


class PrefixCounter:
    """``counts(text)[k]`` is the number of tokens of ``text[:k]``.

    A prefix's encoding ends in exactly one token, and what stands before that token is the
    encoding of a shorter prefix.  So one table entry per prefix, its count and last token,
    is filled from shorter ones: a token that ends the prefix is its last one if it may
    follow the last token of what it leaves, and the pair test needs the two tokens alone.
    An open prefix goes on as a word; a closed one carries the mark of a word's end.
    """

    def __init__(self, path: str | None = None):
        import ahocorasick

        self.coder = WordCoder(path)
        self.bytes_of: dict[int, bytes] = {}
        bodies: dict[bytes, list[int]] = {}
        for token, rank in self.coder.ranks.items():
            self.bytes_of[rank] = token
            is_closed = len(token) > 1 and token.endswith(END)
            body = token[:-1] if is_closed else token
            bodies.setdefault(body, [-1, -1])[is_closed] = rank
        self.tokens = ahocorasick.Automaton()  # yields the tokens that end at each byte
        for body, (opened, closed) in bodies.items():
            self.tokens.add_word(body.decode("latin-1"), (len(body), opened, closed))
        self.tokens.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = _Pieces(self)

    def follows(self, left: int, right: int) -> bool:
        """Whether merging keeps the two tokens apart at their border."""
        known = self.coder.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        if len(self.pairs) >= 4 * CACHE:
            self.pairs.clear()
        self.pairs[left << 20 | right] = known
        return known

    def word(self, text: str) -> list[int]:
        """Counts of the prefixes of 1, 2, ... characters of a word in lower case."""
        raw = text.encode()
        size = len(raw)
        pairs, follows = self.pairs, self.follows
        last = [0] * (size + 1)  # last token of each open prefix
        count = [0] * (size + 1)
        closed = [0] * (size + 1)
        for end, (length, opened, close) in self.tokens.iter(raw.decode("latin-1")):
            i = end + 1
            j = i - length
            if j:
                left, n = last[j] << 20, count[j]
                if opened >= 0 and not count[i]:
                    known = pairs.get(left | opened)
                    if known or known is None and follows(last[j], opened):
                        last[i], count[i] = opened, n + 1
                if close >= 0 and not closed[i]:
                    known = pairs.get(left | close)
                    if known or known is None and follows(last[j], close):
                        closed[i] = n + 1
            else:
                if opened >= 0:
                    last[i], count[i] = opened, 1
                if close >= 0:
                    closed[i] = 1
        if size == len(text):
            return closed[1:]
        # Characters of several bytes: a prefix ends where the next byte begins a character.
        return [closed[i] for i in range(1, size + 1) if i == size or raw[i] & 0xC0 != 0x80]

    def counts(self, text: str) -> np.ndarray:
        """Token counts of all ``len(text) + 1`` prefixes."""
        if not text:
            return np.zeros(1, np.int64)
        if not self.coder.simple(text):
            return self._general(text)
        found = SPACED.findall(text.lower())
        inside = np.frombuffer(b"".join(map(self.pieces.__getitem__, found)), np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(sizes)
        before = np.zeros(len(found), np.int32)
        if len(found) > 1:
            before[1:] = np.cumsum(inside[ends[:-1] - 1])
        counts = np.empty(len(text) + 1, np.int32)
        counts[0] = 0
        covered = int(ends[-1]) if len(found) else 0
        if covered:
            counts[1 : covered + 1] = inside
            counts[1 : covered + 1] += np.repeat(before, sizes)
        counts[covered + 1 :] = counts[covered]
        return counts

    def _general(self, text: str) -> np.ndarray:
        """The same for texts that the library splits: words from its offsets, prefixes
        inside a word by ``word`` where its letters stay one to one in lower case, else, and
        inside special tokens, by encoding from the last word that a cut there can change."""
        code = self.coder.library.encode(text, add_special_tokens=False)
        special = {i for i in self.coder.library.get_added_tokens_decoder()}
        spans: list[list[int]] = []  # start, end, tokens, is special
        for (start, end), ident, word in zip(code.offsets, code.ids, code.word_ids):
            if ident in special:
                spans.append([start, end, 1, 1, -1])
            elif spans and spans[-1][4] == word and not spans[-1][3]:
                spans[-1][1] = max(spans[-1][1], end)
                spans[-1][2] += 1
            else:
                spans.append([start, end, 1, 0, word])
        counts = np.zeros(len(text) + 1, np.int64)
        done = total = n = 0
        before = (0, -1, 1)  # start, end and kind of the stretch before
        starts = {0}
        while n < len(spans):
            start, end, tokens, is_special, _ = spans[n]
            first = n
            # Where a letter grows in lower case, its mark may begin the next word: the two
            # share a place, and a cut there changes the word before as well.
            while n + 1 < len(spans) and spans[n + 1][0] < end:
                n += 1
                end, tokens = max(end, spans[n][1]), tokens + spans[n][2]
                is_special |= spans[n][3]
            shared = n > first
            n += 1
            start = max(start, done)
            counts[done : start + 1] = total
            piece = text[start:end]
            lower = piece.lower()
            if is_special or shared:
                near = before[1] == start and not before[2]
                base_start = before[0] if near else start
                base = int(counts[base_start])
                for k in range(start + 1, end):
                    counts[k] = base + len(self.coder.whole(text[base_start:k]))
            elif len(piece) > 1:
                inner = self.word(lower) if lower.isalpha() and len(lower) == len(piece) else []
                if len(inner) == len(piece) and inner[-1] == tokens:
                    counts[start + 1 : end + 1] = np.asarray(inner) + total
                else:
                    for k in range(start + 1, end):
                        counts[k] = total + len(self.coder.whole(text[start:k]))
            total += tokens
            counts[end] = total
            done = end
            before = (start, end, is_special)
            starts.add(start)
        counts[done:] = total
        self._mend(text, counts, sorted(starts), spans)
        return counts

    def _mend(
        self, text: str, counts: np.ndarray, starts: list[int], spans: list[list[int]]
    ) -> None:
        """Count anew in words with a mark, or a letter that grows in lower case, and beside
        them, where a cut changes what is before it: from the start of the word before, or of
        one further back whose start no such cut can change."""
        loose = [unicodedata.category(c)[0] == "M" or len(c.lower()) > 1 for c in text]
        if not any(loose):
            return
        for start, end, *_ in spans:
            if any(loose[start:end]):
                loose[start:end] = [True] * (end - start)
        for k in range(1, len(text)):
            if not (loose[k - 1] or loose[k]):
                continue
            at = max(0, bisect.bisect_left(starts, k) - 2)
            while at and (loose[starts[at]] or loose[starts[at] - 1]):
                at -= 1
            base = starts[at]
            counts[k] = counts[base] + len(self.coder.whole(text[base:k]))


class _Pieces(dict):
    """Counts of the prefixes of a word with the white space before it, packed."""

    def __init__(self, counter: PrefixCounter):
        self.counter = counter

    def __missing__(self, piece: str) -> bytes:
        word = piece.lstrip("\t\n\x0b\x0c\r \x85\xa0")
        if word in SHORT:
            whole = self.counter.coder.whole
            inside = [len(whole(word[:k])) for k in range(1, len(word) + 1)]
        else:
            inside = self.counter.word(word)
        value = counts_packed([0] * (len(piece) - len(word)) + inside)
        if len(piece) <= LONGEST:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = value
        return value


def counts_packed(counts: list[int]) -> bytes:
    return array.array("I", counts).tobytes()


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens, without encoding it.

    Counts may fall by one where a cut word has more tokens than the whole; the search is
    from the end.
    """
    fitting = np.flatnonzero(counts <= budget)
    return int(fitting[-1]) if len(fitting) else 0


@functools.lru_cache(maxsize=2)
def prefix_counter(path: str | None) -> PrefixCounter:
    """One counter for each vocabulary in a worker process, kept from task to task."""
    return PrefixCounter(path)


FIELDS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType(), False),
        T.StructField("marks", T.ArrayType(T.LongType(), False), False),
    ]
)


def count_tokens(
    docs: DataFrame,
    *,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    result: str = "counted",
    budgets: Sequence[int] = (LIMIT,),
    path: str | None = None,
) -> DataFrame:
    """``carry`` and a struct: ``n_tokens``, the count at the last prefix, and ``marks``, for
    each budget the characters of the longest prefix within it.

    Null and empty texts have no tokens and marks of 0.  Rows are independent of each other:
    repeated rows repeat, an empty table gives an empty one, other columns are not read.
    Texts of any length are counted whole; a text's prefix table is 8 bytes a character and
    lives only while the text is worked on.
    """
    limits = list(budgets)

    def start():
        counter = prefix_counter(path)

        def compute(texts):
            rows = []
            for value in texts:
                counts = counter.counts(value or "")
                rows.append((int(counts[-1]), [longest_prefix(counts, b) for b in limits]))
            return rows

        return compute

    return annotate(docs, [text], carry, result, FIELDS, start)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    sized = docs.select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    counted = count_tokens(sized, carry=("doc_id", "n_bytes"))
    tokens = F.col("counted.n_tokens")
    return counted.select(
        "doc_id",
        "n_bytes",
        tokens.alias("n_tokens"),
        (tokens > LIMIT).alias("over_limit"),
        F.col("counted.marks")[0].alias("chars_within_limit"),
    )
