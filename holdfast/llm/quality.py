"""Quality rules: how much of a text lies inside repeated word sequences and lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.batches import annotate, column, free_name
from holdfast.llm.rows import documents
from holdfast.llm.text import SPACES, character_sizes, count_spaces, encoded

SYMBOLS = "#*$%&|<>"  # fixed values, as are the two base limits
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Largest share of word characters inside n-grams that occur twice or more, by n: longer
#: copies say more, so less of them is let pass.  All lie above the shares of the documents
#: labelled good, which reach 0.352 at every one of these lengths.
NGRAM_LIMITS: Mapping[int, float] = {5: 0.44, 6: 0.43, 7: 0.42, 8: 0.41, 9: 0.40, 10: 0.39}
#: Largest share of word characters inside lines equal to an earlier line; good documents
#: reach 0.176.
LINE_LIMIT = 0.25
#: Most symbols of ``SYMBOLS`` per word, in the pipeline's step against symbol noise.
SYMBOL_LIMIT = 0.1

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def rolling_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes, modulo 2**64, of all windows of ``n`` word hashes."""
    count = len(words) - n + 1
    total = words[:count].copy()
    for i in range(1, n):
        total *= _MULTIPLIER
        total += words[i : i + count]
    return total


def inside_repeats(hashes: np.ndarray, n: int) -> np.ndarray:
    """For each word, whether it lies in a window whose hash occurs twice or more."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    steps = np.zeros(len(hashes) + n, np.int32)
    if same.any():
        repeated = np.zeros(len(hashes), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        at = np.flatnonzero(repeated)
        steps[at] += 1
        np.subtract.at(steps, at + n, 1)
    return np.cumsum(steps[:-1]) > 0


def measure(text: str, lengths: Sequence[int]) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, the shares of word
    characters inside repeated n-grams of each length, and the share inside repeated lines."""
    raw = encoded(text)
    words = raw.split()  # bytes split at exactly the six characters of SPACES
    ascii_only = text.isascii()
    word_chars = len(text) - count_spaces(text)
    n_symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup_lines = dup_chars = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
            dup_chars += len(line) - count_spaces(line)
        elif line.strip(SPACES):
            seen.add(line)
    hashed = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    hashed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    repeat_words = 0
    shares = [0.0] * len(lengths)
    if len(words) >= 3:
        repeat_words = int(inside_repeats(rolling_hashes(hashed, 3), 3).sum())
        # A word inside a longer repeated window is inside a repeated window of 3 too.
        if repeat_words:
            sizes = character_sizes(words, ascii_only)
            for i, n in enumerate(lengths):
                if len(words) >= n:
                    inside = inside_repeats(rolling_hashes(hashed, n), n)
                    shares[i] = float(sizes[inside].sum()) / word_chars
    line_share = dup_chars / word_chars if word_chars else 0.0
    return len(words), word_chars, n_symbols, dup_lines, repeat_words, shares, line_share


FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("word_chars", T.LongType(), False),
        T.StructField("n_symbols", T.LongType(), False),
        T.StructField("n_dup_lines", T.LongType(), False),
        T.StructField("n_repeat_words", T.LongType(), False),
        T.StructField("base_failed", T.BooleanType(), False),
        T.StructField("ngram_shares", T.ArrayType(T.DoubleType(), False), False),
        T.StructField("line_share", T.DoubleType(), False),
        T.StructField("kept", T.BooleanType(), False),
    ]
)


def assess(
    docs: DataFrame,
    *,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    result: str = "quality",
    limits: Mapping[int, float] = NGRAM_LIMITS,
    line_limit: float = LINE_LIMIT,
) -> DataFrame:
    """``carry`` and a struct of measures with the verdict ``kept``.

    A text is kept if it has at least 50 words, at most half of its words lie in repeated
    3-word windows, and no more than the limit of its word characters lies inside repeated
    n-grams of each length and inside lines equal to an earlier one.  Symbols are counted but
    decide nothing.  Null and empty texts have no words and go.  Rows are judged alone: repeated rows repeat, an empty table gives
    an empty one, other columns are not read.
    """
    lengths, most = list(limits), list(limits.values())

    def start():
        def compute(texts):
            rows = []
            for value in texts:
                *base, shares, line_share = measure(value or "", lengths)
                n_words, repeated = base[0], base[4]
                failed = n_words < LEAST_WORDS or 100 * repeated > MOST_REPEATED_PERCENT * n_words
                kept = (
                    not failed
                    and all(s <= m for s, m in zip(shares, most))
                    and line_share <= line_limit
                )
                rows.append((*base, failed, shares, line_share, kept))
            return rows

        return compute

    return annotate(docs, [text], carry, result, FIELDS, start)


def keep_good(docs: DataFrame, symbol_limit: float | None = None) -> DataFrame:
    """The documents that pass, with all their columns; with ``symbol_limit`` a further step
    leaves out those with more symbols per word, which repetition does not find."""
    name = free_name(docs, "_quality")
    judged = assess(docs, carry=docs.columns, result=name).where(column(name)["kept"])
    if symbol_limit is not None:
        q = column(name)
        judged = judged.where(q["n_symbols"] <= F.lit(symbol_limit) * q["n_words"])
    return judged.select(*map(column, docs.columns))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("quality")
    return assess(documents(spark, sf_dir)).select(
        "doc_id",
        *[
            q[name].alias(name)
            for name in (
                "n_words",
                "word_chars",
                "n_symbols",
                "n_dup_lines",
                "n_repeat_words",
                "base_failed",
                "kept",
                "line_share",
            )
        ],
        *[q["ngram_shares"][i].alias(f"share_{n}_grams") for i, n in enumerate(NGRAM_LIMITS)],
    )
