"""Fast exact token ids for the vocabulary of word ends (``word_bpe_49k.json``).

The library splits a text into words and merges inside each word alone, so the ids of a text
are those of its words in a row.  Words are looked up in a bounded cache; a new word goes to a
byte-pair coder that has the same merges as ranks.  Texts beyond Latin-1, texts that may hold
a special token and very long words are left to the library itself.
"""

from __future__ import annotations

import array
import functools
import os
import re
import unicodedata

DEFAULT = "word_bpe_49k.json"
END = b"\xff"  # stands for the end of a word; no UTF-8 text has this byte
LONGEST = 48  # characters; longer words are neither cached nor coded here
CACHE = 300_000  # words; the cache is emptied when it is full

_LATIN = [chr(c) for c in range(256)]
_SPACE = "\t\n\x0b\x0c\r \x85\xa0"
_LETTER = "".join(c for c in _LATIN if unicodedata.category(c)[0] == "L")
_NUMBER = "".join(c for c in _LATIN if unicodedata.category(c)[0] == "N")
# Fixed value: the words of the tokenizer file, with its classes written out for Latin-1.
_WORD = f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+"
WORD = re.compile(_WORD)
#: A word with the white space before it; such pieces cover a text but for its tail.
SPACED = re.compile(f"[{_SPACE}]*(?:{_WORD})")


def vocabulary_path(path: str | None) -> str:
    """The given file, else the installed one; asked on the machine that opens it."""
    import public_tokenizers

    return path or public_tokenizers.path(DEFAULT)


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordCoder:
    """Token ids of texts, equal to the library's without added special tokens."""

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks fill the cores
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary_path(path))
        self.library.no_padding()
        self.library.no_truncation()
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        self.mark = os.path.commonprefix(sorted(special)) if special else None
        bytes_of = byte_alphabet()
        self.ranks = {}
        for token, rank in self.library.get_vocab(with_added_tokens=False).items():
            if token in special:
                continue
            body, end = (token[:-4], END) if token.endswith("</w>") else (token, b"")
            self.ranks[bytes(bytes_of[c] for c in body) + end] = rank
        coder = tiktoken.Encoding(
            "words", pat_str=r"\S+", mergeable_ranks=self.ranks, special_tokens={}
        )
        self.merge = coder._core_bpe.encode_single_piece
        self.cache: dict[str, bytes] = _Words(self)

    def simple(self, text: str) -> bool:
        """Whether the words of the text are those that ``WORD`` finds in its lower case."""
        if self.mark is not None and self.mark in text:
            return False
        return text.isascii() or max(text) < "Ā"

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not self.simple(text):
            return packed(self.whole(text))
        return b"".join(map(self.cache.__getitem__, WORD.findall(text.lower())))


class _Words(dict):
    def __init__(self, coder: WordCoder):
        self.coder = coder

    def __missing__(self, word: str) -> bytes:
        if len(word) > LONGEST:
            return packed(self.coder.whole(word))
        value = packed(self.coder.merge(word.encode() + END))
        if len(self) >= CACHE:
            self.clear()
        self[word] = value
        return value


def packed(ids: list[int]) -> bytes:
    values = array.array("I", ids)
    if values.itemsize != 4 or array.array("H", [1]).tobytes() != b"\x01\x00":
        return b"".join(i.to_bytes(4, "little") for i in ids)
    return values.tobytes()


@functools.lru_cache(maxsize=2)
def word_coder(path: str | None) -> WordCoder:
    """One coder for each vocabulary in a worker process, kept from task to task."""
    return WordCoder(path)
