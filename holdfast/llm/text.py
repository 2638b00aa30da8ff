"""Words and lines of whole texts, as the contracts define them."""

from __future__ import annotations

import numpy as np

#: The characters between words.
SPACES = " \t\n\x0b\x0c\r"
#: The same as a regular expression for words and for SQL functions.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def encoded(text: str) -> bytes:
    """UTF-8; a lone surrogate, which Spark never yields, becomes a question mark."""
    return text.encode("utf-8", "replace")


def count_spaces(text: str) -> int:
    return sum(map(text.count, SPACES))


def character_sizes(words: list[bytes], ascii_only: bool) -> np.ndarray:
    """Code points of each word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    if ascii_only or not len(words):
        return sizes
    data = np.frombuffer(b"".join(words), np.uint8)
    starts = np.cumsum(sizes) - sizes
    return np.add.reduceat((data & 0xC0 != 0x80).astype(np.int64), starts)
