"""Toxicity: obfuscated words are decoded under a character language model, then scored."""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.batches import SLICE, annotate, column, limit_batches
from holdfast.llm.rows import documents
from holdfast.session import store

FIT_ROWS = 20_000  # labelled rows that the classifier is fitted on, at most
LEXICON = 65_536  # features of the classifier, at most, the strongest by evidence
LEAST_TOXIC_DOCS = 5  # documents with label 1 that hold a feature
LEAST_EVIDENCE = 24.0  # likelihood ratio statistic of a feature
PREFIXES = (4, 5, 6)
MOST_COUNTED = 400_000  # features that a task counts before it hands them on

MOST_TRIGRAMS = 1 << 18  # kept of the language model, the most frequent; others back off
MOST_PAIRS = 1 << 17
MOST_HELD = 1 << 20  # trigrams that a task holds before it hands them on
_PRIOR = 8.0  # weight of the shorter context

# Letters of the language model: letters and marks of any script in lower case; all else is a
# break.  Latin-1 letters have small numbers besides, for which counting is one pass.
_NO_LETTERS = "\xaa\xba"  # fixed values: ordinal signs


@functools.lru_cache(maxsize=1 << 16)
def is_letter(c: str) -> bool:
    return (c.isalpha() and c not in _NO_LETTERS) or unicodedata.category(c)[0] == "M"


class _Breaks(dict):
    """Code points of letters as themselves, of all else as a blank."""

    def __missing__(self, code: int) -> int:
        self[code] = found = code if is_letter(chr(code)) else 32
        return found


_BREAKS = _Breaks()
_LATIN = [chr(c) for c in range(256) if is_letter(chr(c)) and chr(c).islower()]
WIDTH = 64
assert len(_LATIN) < WIDTH
_TO_LETTERS = bytes(c if chr(c) in _LATIN else 32 for c in range(256))
_BITS = 21  # of a code point
_POINT = (1 << _BITS) - 1

# The letters that other characters stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l",
}
PUNCTUATION = "\"'`.,;:!?()[]{}<>#%&*/\\|-_=+~^$@"
COST_LETTER, COST_DROP, COST_DIGIT_DROP, COST_COLLAPSE, COST_UNDOUBLE = 1.5, 0.5, 6.0, 0.5, 3.0
_SPACED = re.compile(r"(?<!\S)\S(?:[ ._*-]\S){2,}(?!\S)")
_RUN = re.compile(r"(\S)\1\1")
_JUNK = re.compile(r"([^\w\s])\1{2,}")
CACHE = 100_000  # decoded tokens kept in a worker


@functools.lru_cache(maxsize=1)
def _numbers() -> np.ndarray:
    """By code point: 0 for a break, below ``WIDTH`` for a Latin-1 letter, else ``WIDTH``."""
    found = np.zeros(0x110000, np.uint8)
    found[[c for c in range(0x110000) if is_letter(chr(c))]] = WIDTH
    found[[ord(c) for c in _LATIN]] = np.arange(1, len(_LATIN) + 1)
    return found


def _packed(a, b, c):
    return (a << 2 * _BITS) | (b << _BITS) | c


class _Trigrams:
    """Counts of letter trigrams, with 0 for a break, by their packed code points."""

    def __init__(self):
        self.latin = np.zeros(WIDTH**3, np.int64)
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def add(self, texts: Sequence[str]) -> None:
        joined = f"\n\n{'\n\n'.join(texts).lower()}\n\n"  # no trigram spans two texts
        points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        numbers = _numbers()[points].astype(np.int64)
        if len(points) < 3:
            return
        a, b, c = numbers[:-2], numbers[1:-1], numbers[2:]
        small = (a < WIDTH) & (b < WIDTH) & (c < WIDTH)
        keys = (a * WIDTH + b) * WIDTH + c
        self.latin += np.bincount(keys[small], minlength=WIDTH**3)
        if small.all():
            return
        points[numbers == 0] = 0
        a, b, c = points[:-2][~small], points[1:-1][~small], points[2:][~small]
        keys, counts = np.unique(_packed(a, b, c), return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > MOST_HELD:
            self._merge()

    def _merge(self) -> None:
        keys, where = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(where, np.concatenate(self.counts)).astype(np.int64)
        self.keys, self.counts, self.held = [keys], [counts], len(keys)

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """All counts so far, which start anew."""
        at = np.flatnonzero(self.latin)
        points = np.array([0, *map(ord, _LATIN)], np.int64)
        latin = _packed(points[at // WIDTH**2], points[at // WIDTH % WIDTH], points[at % WIDTH])
        if self.keys:
            self._merge()
        made = (
            np.concatenate([latin, *self.keys]),
            np.concatenate([self.latin[at], *self.counts]),
        )
        self.__init__()
        return made


class LanguageModel:
    """Counts of trigrams, pairs and single letters, and what follows a pair or a letter."""

    def __init__(self, three: dict, two: dict, one: dict, after_two: dict, after_one: dict):
        self.three, self.two, self.one = three, two, one
        self.after_two, self.after_one = after_two, after_one
        self.all = sum(one.values()) + max(WIDTH, len(one))

    def log_p(self, key: int) -> float:
        """log p(third letter | two before), interpolated with shorter contexts."""
        pair = key & (1 << 2 * _BITS) - 1
        p1 = (self.one.get(key & _POINT, 0) + 1) / self.all
        p2 = (self.two.get(pair, 0) + _PRIOR * p1) / (
            self.after_one.get(pair >> _BITS, 0) + _PRIOR
        )
        p3 = (self.three.get(key, 0) + _PRIOR * p2) / (
            self.after_two.get(key >> _BITS, 0) + _PRIOR
        )
        return math.log(p3)


def language_model(docs: DataFrame, text: str = "text") -> LanguageModel:
    """The letters of all texts, in any script, counted where they are read.

    The number of trigrams grows with the texts and their scripts.  The most frequent
    ``MOST_TRIGRAMS`` and ``MOST_PAIRS`` are kept, as the model goes to every task; rarer ones
    get what their pair, or their last letter, makes of them.
    """
    limit_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams = _Trigrams()

        def counts() -> pa.RecordBatch:
            keys, n = trigrams.taken()
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                texts = batch.column(0).slice(low, SLICE).to_pylist()
                trigrams.add([t for t in texts if t])
            if trigrams.held > MOST_HELD // 2:
                yield counts()
        yield counts()

    parts = docs.select(column(text)).mapInArrow(run, "key long, n long")
    counted = store(parts.groupBy("key").agg(F.sum("n").alias("n")), "trigrams")

    def summed(key, most: int) -> dict[int, int]:
        rows = counted.groupBy(key.alias("key")).agg(F.sum("n").alias("n"))
        kept = rows.orderBy(F.desc("n"), "key").limit(most).toPandas()
        return dict(zip(kept["key"].tolist(), kept["n"].tolist()))

    key, pair = F.col("key"), F.lit((1 << 2 * _BITS) - 1)
    return LanguageModel(
        summed(key, MOST_TRIGRAMS),
        summed(key.bitwiseAND(pair), MOST_PAIRS),
        summed(key.bitwiseAND(F.lit(_POINT)), 0x110000),
        summed(F.shiftright(key, _BITS), MOST_PAIRS),
        summed(F.shiftright(key, _BITS).bitwiseAND(F.lit(_POINT)), 0x110000),
    )


class Decoder:
    """Restores obfuscated words: the likeliest path through a lattice of readings."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.costs: dict[int, float] = {}
        self.known: dict[str, str] = {}

    def log_p(self, key: int) -> float:
        found = self.costs.get(key)
        if found is None:
            if len(self.costs) >= CACHE:
                self.costs.clear()
            found = self.costs[key] = self.model.log_p(key)
        return found

    def edges(self, noisy: str) -> list[list[tuple[int, str, float]]]:
        """From each position: next position, letters read, cost.

        Letters read as themselves, a run of one letter also as one or two, other characters
        as the letters they stand for, as nothing, or as a break.
        """
        out: list[list[tuple[int, str, float]]] = [[] for _ in noisy]
        start_of_run = 0
        for i, c in enumerate(noisy):
            if i and c != noisy[i - 1]:
                start_of_run = i
            options = out[i]
            if is_letter(c):
                options.append((i + 1, c, 0.0))
                if i == start_of_run:
                    j = i + 1
                    while j < len(noisy) and noisy[j] == c:
                        j += 1
                    if j - i > 1:
                        options.append((j, c, COST_COLLAPSE if j - i > 2 else COST_UNDOUBLE))
                    if j - i > 2:
                        options.append((j, c + c, COST_COLLAPSE))
                continue
            options += [(i + 1, x, COST_LETTER) for x in LEET.get(c, "")]
            options.append((i + 1, "", COST_DIGIT_DROP if c.isalnum() else COST_DROP))
            options.append((i + 1, " ", COST_DIGIT_DROP if c.isalnum() else COST_LETTER))
        return out

    def decode(self, noisy: str) -> str:
        """Viterbi search; a state is the last two letters read."""
        log_p = self.log_p
        states: list[dict[int, tuple[float, tuple | None]]] = [{} for _ in range(len(noisy) + 1)]
        states[0][0] = (0.0, None)
        for i, options in enumerate(self.edges(noisy)):
            for state, (score, path) in states[i].items():
                for to, read, cost in options:
                    total, now, way = score - cost, state, path
                    for letter in read:
                        symbol = ord(letter) if letter != " " else 0
                        total += log_p(now << _BITS | symbol)
                        now = (now & _POINT) << _BITS | symbol
                        way = (letter, way)
                    best = states[to].get(now)
                    if best is None or total > best[0]:
                        states[to][now] = (total, way)
            states[i] = {}
        finals = [(s + log_p(state << _BITS), state, way) for state, (s, way) in states[-1].items()]
        way = max(finals, key=lambda f: f[:2])[2]
        letters = []
        while way:
            letter, way = way
            letters.append(letter)
        return "".join(reversed(letters))

    def word(self, noisy: str) -> str:
        known = self.known.get(noisy)
        if known is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            known = self.known[noisy] = self.decode(noisy)
        return known

    def restore(self, text: str) -> str:
        """The lower-case text with its noisy parts decoded.

        A word of letters alone, without a run of three, has one path only and is not
        searched; runs of three equal symbols part words.
        """
        low = text.lower()
        if _JUNK.search(low):
            low = _JUNK.sub(" ", low)
        if _SPACED.search(low):
            low = _SPACED.sub(lambda m: " " + self.word(m.group()) + " ", low)
        tokens = low.split()
        runs = _RUN.search(low) is not None
        changed: dict[str, str] = {}
        for token in set(tokens):
            if token.isalpha():
                if runs and _RUN.search(token):
                    changed[token] = self.word(token)
                continue
            bare = token.strip(PUNCTUATION)
            if bare.isalpha() and not (runs and _RUN.search(bare)):
                edge = token[:1] in LEET or token[-1:] in "$@+"
                if not edge:
                    continue
            if any(map(is_letter, token)):
                changed[token] = self.word(token)
        if not changed:
            return low
        return " ".join([changed.get(t, t) for t in tokens])


def spaced_letters(restored: str) -> str:
    """Words of letters, with a blank before, between and after them."""
    try:
        words = restored.encode("latin-1").translate(_TO_LETTERS).split()
        return (b" " + b" ".join(words) + b" ").decode("latin-1")
    except UnicodeEncodeError:
        return " " + " ".join(restored.translate(_BREAKS).split()) + " "


# Scripts that set no blanks between words.
_UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"
)


def features(letters: str) -> set[str]:
    """Whole words and word beginnings, each with the blanks that bound it; of scripts without
    blanks also all stretches of two and three letters."""
    found = set()
    for word in set(letters.split()):
        if len(word) > 2:
            found.add(f" {word} ")
            found.update(f" {word[:k]}" for k in PREFIXES if len(word) > k)
        if len(word) > 1 and not word.isascii() and _UNSPACED.search(word):
            found.update(word[i : i + k] for k in (2, 3) for i in range(len(word) - k + 1))
    return found


def evidence(all_toxic: int, all_clean: int) -> Column:
    """Likelihood ratio statistic of a feature's table, from its columns ``toxic`` and
    ``clean``; 0 unless it leans to label 1."""
    toxic, clean = F.col("toxic").cast("double"), F.col("clean").cast("double")
    yes, no = F.lit(float(all_toxic)), F.lit(float(all_clean))
    total, seen = yes + no, toxic + clean
    cells = (
        (toxic, seen * yes),
        (clean, seen * no),
        (yes - toxic, (total - seen) * yes),
        (no - clean, (total - seen) * no),
    )
    parts = [
        F.when((n > 0) & (e > 0), n * F.log(F.try_divide(n * total, e))).otherwise(0.0)
        for n, e in cells
    ]
    return F.when(toxic * no > clean * yes, 2 * sum(parts[1:], parts[0])).otherwise(0.0)


class Matcher:
    """Numbers of a text from the lexicon: words that match, and their weights."""

    def __init__(self, weights: dict[str, float]):
        import ahocorasick

        self.found = ahocorasick.Automaton() if weights else None
        for feature, weight in weights.items():
            self.found.add_word(feature, (len(feature), weight))
        if weights:
            self.found.make_automaton()

    def numbers(self, letters: str) -> tuple[float, float, float]:
        """Heaviest match, logarithms of the number of words matched and of their weights'
        sum; a word counts once, by its heaviest match."""
        at: dict[int, float] = {}
        if self.found is not None:
            for end, (length, weight) in self.found.iter(letters):
                start = end - length
                at[start] = max(weight, at.get(start, 0.0))
        if not at:
            return 0.0, 0.0, 0.0
        return max(at.values()), math.log1p(len(at)), math.log1p(sum(at.values()))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights, intercept first, by Newton's method; the intercept is not shrunk."""
    full = np.c_[np.ones(len(x)), x]
    weights = np.zeros(full.shape[1])
    penalty = ridge * np.eye(len(weights))
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(full @ weights, -30, 30)))
        step = np.linalg.solve(
            (full * (p * (1 - p))[:, None]).T @ full + penalty,
            full.T @ (y - p) - penalty @ weights,
        )
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def labelled_sample(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids outside the held-out fifth, the first by hash; an id
    whose labels differ counts as toxic."""
    usable = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
    one = usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    ordered = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return ordered.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic"))


def labelled_texts(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``text`` and ``_toxic`` of the sampled ids, one row each: of rows that repeat an id,
    the text with the smallest hash, null only if there is no other.  Tasks reduce their own rows first."""
    sample = F.broadcast(labelled_sample(labels, rows))  # at most ``rows`` pairs of numbers
    chosen = docs.join(sample, column("doc_id") == F.col("_id"))
    text = column("text")
    first = F.min(F.struct(text.isNull(), F.xxhash64(text), text.alias("text"))).alias("first")
    return chosen.groupBy("_id", "_toxic").agg(first).select("first.text", "_toxic")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


class Model:
    """All that scoring needs, small enough to go to each task."""

    def __init__(self, language: LanguageModel, lexicon: dict[str, float], weights: np.ndarray):
        self.language, self.lexicon, self.weights = language, lexicon, weights


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Language model from all texts, lexicon and weights from a bounded labelled sample.

    Without labels of both kinds the lexicon is empty and all scores equal the share of 1s.
    """
    language = language_model(docs)
    chosen = store(labelled_texts(docs, labels, rows), "labelled-texts")

    shared = docs.sparkSession.sparkContext.broadcast(language)  # bounded, see language_model

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        seen: list[Counter] = [Counter(), Counter()]

        def counts() -> pa.RecordBatch:
            names = list(seen[0].keys() | seen[1].keys())
            columns = [[seen[k][n] for n in names] for k in (1, 0)]
            arrays = [pa.array(names, pa.string()), *(pa.array(c, pa.int64()) for c in columns)]
            for counter in seen:
                counter.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["feature", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                toxic = toxic.as_py()
                seen[toxic].update(features(spaced_letters(decoder.restore(text.as_py() or ""))))
                seen[toxic][""] += 1  # documents
                if len(seen[0]) + len(seen[1]) > MOST_COUNTED:
                    yield counts()
        yield counts()

    counted = (
        chosen.mapInArrow(count, "feature string, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    counted = store(counted, "features")
    sums = counted.where("feature = ''").first()
    all_toxic, all_clean = (sums["toxic"], sums["clean"]) if sums else (0, 0)
    # The evidence of every feature is known before any is left out.
    strong = (
        counted.where((F.col("toxic") >= LEAST_TOXIC_DOCS) & (F.col("feature") != ""))
        .withColumn("evidence", evidence(all_toxic, all_clean))
        .where(F.col("evidence") >= LEAST_EVIDENCE)
        .orderBy(F.desc("evidence"), "feature")
        .limit(LEXICON)
        .select("feature", "toxic", "clean")
    )
    lexicon = {
        f: math.log((t + 0.5) / (all_toxic + 1)) - math.log((c + 0.5) / (all_clean + 1))
        for f, t, c in strong.collect()
    }

    fields = T.StructType([T.StructField(f"x{i}", T.DoubleType(), False) for i in range(3)])

    def start():
        decoder, matcher = Decoder(shared.value), Matcher(lexicon)
        return lambda texts: [
            matcher.numbers(spaced_letters(decoder.restore(t or ""))) for t in texts
        ]

    measured = annotate(chosen, ["text"], ["_toxic"], "m", fields, start)
    frame = measured.select("_toxic", "m.*").toPandas()  # at most ``rows`` rows
    y = frame["_toxic"].to_numpy(float)
    if not len(y) or y.min() == y.max() or not lexicon:
        share = float(y.mean()) if len(y) else 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(language, {}, np.array([math.log(share / (1 - share)), 0.0, 0.0, 0.0]))
    x = frame[["x0", "x1", "x2"]].to_numpy(float)
    return Model(language, lexicon, fit_logistic(x, y))


SCORE = T.StructType([T.StructField("score", T.DoubleType(), False)])


def score(
    docs: DataFrame,
    model: Model,
    *,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    result: str = "toxicity",
) -> DataFrame:
    """``carry`` and a struct with ``score``, 0 to 1.

    Only the text is looked at.  Null and empty texts get the score of a text without any
    match.  Rows are scored alone: repeated rows repeat, an empty table gives an empty one,
    other columns are not read.
    """

    shared = docs.sparkSession.sparkContext.broadcast((model.language, model.lexicon))

    def start():
        language, lexicon = shared.value
        decoder, matcher = Decoder(language), Matcher(lexicon)
        bias, *slopes = model.weights.tolist()

        def compute(texts):
            rows = []
            for value in texts:
                x = matcher.numbers(spaced_letters(decoder.restore(value or "")))
                z = bias + sum(a * b for a, b in zip(slopes, x))
                rows.append((1 / (1 + math.exp(-max(-700.0, min(700.0, z)))),))
            return rows

        return compute

    return annotate(docs, [text], carry, result, SCORE, start)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    value = F.col("toxicity.score")
    return score(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        value.alias("score"),
        (value >= 0.5).cast("int").alias("predicted"),
    )
