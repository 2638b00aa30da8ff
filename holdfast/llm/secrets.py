"""Secrets in texts: fixed patterns, and strings that a tokenizer spells in short tokens."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.batches import annotate, column, free_name
from holdfast.llm.rows import documents

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # the same matches as HEX of that length
KINDS = ("assign", "access", "hex", "random")  # the order of kinds at one start

DIGESTS = {32, 40, 48, 56, 64, 96, 128}  # fixed values: hex digits of common digests
MOST_CHARS_PER_TOKEN = 2.2
LEAST_RANDOM = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_RANDOM)
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_ALL_HEX = re.compile(r"[0-9a-fA-F]+")
_PART = re.compile(r"[+/_=-]+")
_BETWEEN = re.compile(r"[^+/_=-]+")
_NAME = re.compile(r"[A-Za-z]+[0-9]{0,4}|[0-9]+")  # one way to match: time in proportion
_HUMP = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
PLACEHOLDER = "[secret]"


@functools.lru_cache(maxsize=2)
def efficiency_coder(path: str | None):
    """Byte-pair coder of the rank file, one for each worker process."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "efficiency", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def is_digest(candidate: str) -> bool:
    """Hex digests of common lengths and UUIDs."""
    if _ALL_HEX.fullmatch(candidate) and len(candidate) in DIGESTS:
        return True
    return _UUID.fullmatch(candidate) is not None


def is_identifier(candidate: str, coder, most: float = MOST_CHARS_PER_TOKEN) -> bool:
    """Words and numbers joined by ``_ - / + =``, where a word may be in camel case and end in
    up to four digits.

    Letters count as words only if the vocabulary spells the lower-case parts, whole or at the
    turns of camel case, in tokens of more than ``most`` letters on average.
    """
    parts = [p for p in _PART.split(candidate) if p]
    if not all(map(_is_name, parts)):
        return False
    letters = tokens = 0
    for part in parts:
        word = part.rstrip("0123456789")
        letters += len(word)
        whole = len(coder.encode_ordinary(word.lower()))
        humps = [h.lower() for h in _HUMP.findall(word)]
        tokens += min(whole, sum(len(coder.encode_ordinary(h)) for h in humps))
    return letters > most * tokens or not letters


def _is_name(part: str) -> bool:
    if not _NAME.fullmatch(part):
        return False
    letters = part.rstrip("0123456789")
    turns = sum(a.islower() and b.isupper() for a, b in zip(letters, letters[1:]))
    return turns * 4 <= len(letters)  # camel case has few turns


def is_random(candidate: str, coder, most: float = MOST_CHARS_PER_TOKEN) -> bool:
    if is_digest(candidate) or len(candidate) > most * len(coder.encode_ordinary(candidate)):
        return False
    return not is_identifier(candidate, coder, most)


LEAST_PLAIN = 4  # letters or digits of a part that parts a string
PLAIN_CHARS_PER_TOKEN = 3.0  # in which the vocabulary spells such a part at least
MOST_PLAIN = 0.15  # share of them in a string that is random as a whole


def random_spans(
    text: str, start: int, end: int, coder, most: float = MOST_CHARS_PER_TOKEN
) -> list[tuple[int, int]]:
    """What is random of a string of token characters.

    A string is cut at its joiners.  Parts that are words, numbers or digests are plain, and
    part the string into runs, of which each is tested, without the short names at its ends.
    Where plain parts are few, as chance makes them in a key, the whole is tested first.
    """
    if end - start < LEAST_RANDOM:
        return []
    digests = [m.span() for m in _UUID.finditer(text, start, end)]
    parts = []  # start, end, plain, short name
    for m in _BETWEEN.finditer(text, start, end):
        part = m.group()
        plain = any(s <= m.start() < e for s, e in digests) or is_digest(part)
        name = not plain and len(part) > 2 and is_identifier(part, coder, PLAIN_CHARS_PER_TOKEN)
        plain |= name and len(part) >= LEAST_PLAIN
        parts.append((*m.span(), plain, name and not plain))
    told = sum(e - s for s, e, plain, _ in parts if plain)
    named = any(parts[i][2] or parts[i][3] for i in (0, -1)) if parts else True
    if not named and told <= MOST_PLAIN * (end - start):
        if is_random(text[start:end], coder, most):
            return [(start, end)]
    spans, run = [], []
    for part in [*parts, (end, end, True, False)]:
        if not part[2]:
            run.append(part)
            continue
        while run and run[0][3]:
            run.pop(0)
        while run and run[-1][3]:
            run.pop()
        if run:
            low, high = run[0][0], run[-1][1]
            while high < end and text[high] == "=":  # the padding belongs to it
                high += 1
            if high - low >= LEAST_RANDOM and is_random(text[low:high], coder, most):
                spans.append((low, high))
        run = []
    return spans


def _until(spans: list[tuple[int, int]], at: int, end: int) -> Iterator[tuple[int, int]]:
    while at < len(spans) and spans[at][0] < end:
        yield spans[at]
        at += 1


def spans_of(text: str, coder, most: float = MOST_CHARS_PER_TOKEN) -> list[tuple]:
    """(start, order of kind, end, start of the value) of all spans, by start and kind."""
    found = []
    low = text.lower()
    if "pass" in low or "secret" in low or "token" in low or "api" in low:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_ASSIGN:
                found.append((m.start(), 0, m.end(), m.start(2)))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                found.append((m.start(), 1, m.end(), m.start()))
    for m in LONG_HEX.finditer(text):
        found.append((m.start(), 2, m.end(), m.start()))
    base = sorted((s, e) for s, _, e, _ in found)
    at = 0  # base spans before it end ahead of all further candidates
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(base) and base[at][1] <= start:
            at += 1
        for s, e in [*_until(base, at, end), (end, end)]:
            found += [(a, 3, b, a) for a, b in random_spans(text, start, s, coder, most)]
            start = max(start, e)
    found.sort()
    return found


def joined(spans: Sequence[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in spans)


def redacted(text: str, spans: Sequence[tuple]) -> str:
    """The text with each value, overlapping ones as one, replaced by a placeholder."""
    parts, at, last = [], 0, -1
    for start, end in sorted((v, e) for _, _, e, v in spans):
        if start <= last:
            last = max(last, end)
            at = max(at, end)
            continue
        parts += [text[at:start], PLACEHOLDER]
        at = last = end
    parts.append(text[at:])
    return "".join(parts)


FIELDS = T.StructType(
    [
        T.StructField("n_assign", T.LongType(), False),
        T.StructField("n_access", T.LongType(), False),
        T.StructField("n_hex", T.LongType(), False),
        T.StructField("n_random", T.LongType(), False),
        T.StructField("base_sha256", T.StringType(), False),
        T.StructField("spans", T.StringType(), False),
        T.StructField("clean_text", T.StringType(), True),
    ]
)


def scan(
    docs: DataFrame,
    *,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    result: str = "secrets",
    most_chars_per_token: float = MOST_CHARS_PER_TOKEN,
    path: str | None = None,
    redact: bool = False,
) -> DataFrame:
    """``carry`` and a struct: counts by kind, digest of the base spans, all spans, and with
    ``redact`` the text without the secrets (null for a null text).

    Strings of 20 or more token characters that are no digest or identifier count as random
    if the vocabulary spells them in tokens of at most 2.2 characters on average; they add
    to the base spans and never overlap them: base spans are cut out, and what is left of a
    string is tested whole and, where words are joined to it, run by run (``random_spans``).  Null and empty texts have no spans.  Rows are
    scanned alone and whole: repeated rows repeat, an empty table gives an empty one, other
    columns are not read.
    """

    def start():
        coder = efficiency_coder(path)

        def compute(texts):
            rows = []
            for value in texts:
                spans = spans_of(value or "", coder, most_chars_per_token)
                counts = [0] * len(KINDS)
                for _, kind, _, _ in spans:
                    counts[kind] += 1
                base = joined([s for s in spans if s[1] < 3])
                digest = hashlib.sha256(base.encode()).hexdigest()
                clean = None
                if redact and value is not None:
                    clean = redacted(value, spans) if spans else value
                rows.append((*counts, digest, joined(spans), clean))
            return rows

        return compute

    return annotate(docs, [text], carry, result, FIELDS, start)


def redact_documents(docs: DataFrame) -> DataFrame:
    """All documents, with their columns; secrets in texts are replaced and ``n_chars``
    counts the new text."""
    name = free_name(docs, "_secrets")
    scanned = scan(docs, carry=docs.columns, result=name, redact=True)
    clean = column(name)["clean_text"]
    new = {"text": clean}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = ~clean.eqNullSafe(column("text"))
        new["n_chars"] = F.when(changed, F.length(clean).cast(kind)).otherwise(column("n_chars"))
    return scanned.select(
        *[new[c].alias(c) if c in new else column(c) for c in docs.columns]
    )


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("secrets")
    return scan(documents(spark, sf_dir)).select(
        "doc_id",
        *[
            s[name].alias(name)
            for name in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")
        ],
    )
