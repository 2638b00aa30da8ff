"""Periodic runs of words, proposed by a dictionary of basic factors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.batches import annotate
from holdfast.llm.rows import documents
from holdfast.llm.text import WORD_PATTERN, encoded

#: A run holds at least so many words, and its period at least so many times.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Words that are searched at one time; a longer text is searched alone and whole.
CHUNK_WORDS = 1 << 17


def named(keys: np.ndarray, at: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """One level of the dictionary: for every position the name of the factor that starts
    there, -1 if it occurs once only, and the distance to its next occurrence, 0 without one.

    ``keys`` are equal for equal factors; ``at`` are their positions in ascending order.
    """
    names, gaps = np.full(count, -1, np.int64), np.zeros(count, np.int64)
    order = np.argsort(keys, kind="stable")  # equal factors stay in the order of the text
    ordered, where = keys[order], at[order]
    same = ordered[1:] == ordered[:-1]
    gaps[where[:-1][same]] = (where[1:] - where[:-1])[same]
    repeated = np.zeros(len(keys), bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    labels = np.zeros(len(keys), np.int64)
    np.cumsum(~same, out=labels[1:])
    names[where[repeated]] = labels[repeated]
    return names, gaps


def proposals(words: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Periods and the positions that propose them, by factor length 1, 2, 4 and so on.

    Where a factor, its next occurrence and the one after that lie equally far apart, at most
    twice the factor's length, their distance is proposed.  A run of period ``q`` holds such a
    progression of the first length that is no less than ``q``, because it holds four periods
    and that length is under ``2 * q``; occurrences of such a factor inside the run lie
    exactly ``q`` apart, so multiples of the period are never proposed for it.
    """
    count = len(words)
    names, gaps = named(words, np.arange(count), count)
    length = 1
    while True:
        near = np.flatnonzero((gaps > length // 2) & (gaps <= 2 * length))
        periods = gaps[near]
        again = gaps[near + periods] == periods
        yield periods[again], near[again]
        if LEAST_PERIODS * length >= longest:
            return
        at = np.flatnonzero((names[:-length] >= 0) & (names[length:] >= 0))
        if not len(at):
            return
        names, gaps = named(names[at] * count + names[at + length], at, count)
        length *= 2


def find_runs(
    words: np.ndarray,
    longest: int | None = None,
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> np.ndarray:
    """Rows ``start, length, period`` of all runs, by start, then period.

    ``words`` are numbers, equal for equal words; several texts may follow each other if they
    share no number, and ``longest`` is then the length of the longest.
    """
    if least_periods < LEAST_PERIODS:
        raise ValueError(f"progressions are sure to exist from {LEAST_PERIODS} periods on")
    if len(words) < 2:
        return np.zeros((0, 3), np.int64)
    found = [*proposals(words, len(words) if longest is None else longest)]
    periods, places = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(periods, kind="stable")
    periods, places = periods[order], places[order]
    bounds = np.flatnonzero(np.diff(periods, prepend=-1, append=-1))
    runs = []
    for low, high in zip(bounds[:-1], bounds[1:]):
        q = int(periods[low])
        same = np.zeros(len(words) - q + 2, np.int8)
        same[1:-1] = words[q:] == words[:-q]
        edges = np.flatnonzero(np.diff(same))
        starts, lengths = edges[::2], edges[1::2] - edges[::2] + q
        holds = np.unique(np.searchsorted(starts, places[low:high], "right") - 1)
        holds = holds[lengths[holds] >= max(least_words, least_periods * q)]
        runs.append(np.stack([starts[holds], lengths[holds], np.full(len(holds), q)], axis=1))
    if not runs:
        return np.zeros((0, 3), np.int64)
    table = np.concatenate(runs)
    return table[np.lexsort((table[:, 2], table[:, 0]))]


def kept_words(count: int, runs: np.ndarray) -> np.ndarray:
    """For each word, whether no run contains it after that run's first period."""
    steps = np.zeros(count + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.subtract.at(steps, runs[:, 0] + runs[:, 1], 1)
    return np.cumsum(steps[:-1]) == 0


def _chunks(texts: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for words in texts:
        if held and size + len(words) > CHUNK_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def search(texts: Sequence[str | None], **limits: int) -> list[tuple]:
    """Number of words, runs and collapsed text of each text."""
    out = []
    for chunk in _chunks([encoded(t or "").split() for t in texts]):
        numbers, used = [], 0
        for words in chunk:  # a text's words are numbers of its own
            number = {w: i for i, w in enumerate(dict.fromkeys(words), used)}
            numbers.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            used += len(number)
        table = find_runs(np.concatenate(numbers), max(map(len, chunk)), **limits)
        ends = np.cumsum([len(words) for words in chunk])
        cuts = np.searchsorted(table[:, 0], ends)
        low = at = 0
        for words, end, high in zip(chunk, ends.tolist(), cuts.tolist()):
            runs = table[low:high] - [at, 0, 0]
            if len(runs):
                kept = kept_words(len(words), runs)
                text = b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])
            else:
                text = b" ".join(words)
            out.append((len(words), [*map(tuple, runs.tolist())], text.decode()))
            low, at = high, end
    return out


RUN = T.StructType(
    [T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")]
)
FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("runs", T.ArrayType(RUN, False), False),
        T.StructField("collapsed", T.StringType(), False),
    ]
)


def periodic_runs(
    docs: DataFrame,
    *,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    result: str = "periodic",
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """``carry`` and a struct: ``n_words``; ``runs``, each run's first word (from 0), length
    and smallest period in words, by start, then period; ``collapsed``, the words no run
    contains after its first period, joined by single spaces.

    A run is a longest stretch in which words a period apart are identical, of at least
    ``least_words`` words and ``least_periods`` (4 or more) periods.  Whole texts are searched.
    Null and empty texts and texts without words have no run and collapse to the empty text.
    Rows are searched alone: repeated rows repeat, an empty table gives an empty one, other
    columns are not read.
    """

    def start():
        return lambda texts: search(texts, least_words=least_words, least_periods=least_periods)

    return annotate(docs, [text], carry, result, FIELDS, start)


def planted(doc_id: Column, text: Column) -> Column:
    """The text, or in about one of ten documents, by the id's checksum, its words with those
    from one place on replaced by repeats of the first of them.  A null id changes nothing."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def changed(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        repeats = F.flatten(F.array_repeat(F.slice(words, a + 1, p), times))
        return F.array_join(
            F.concat(F.slice(words, F.lit(1), a), F.slice(repeats, F.lit(1), n - a)), " "
        )

    # An array of one, so that the words are taken from the text once and then named.
    once = F.array(F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)))
    made = F.transform(once, lambda words: F.when(F.size(words) > 0, changed(words)))
    return F.when(h % 10 == 0, F.coalesce(F.element_at(made, 1), text)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    docs = docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    runs = F.col("periodic.runs")
    order = F.expr(
        "reduce(periodic.runs, CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>),"
        " (best, r) -> IF(best IS NULL OR r.length > best.length, r, best))"
    )  # runs come by start, then period, so the first of the longest is the one wanted
    lines = F.transform(
        runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return (
        periodic_runs(docs)
        .withColumn("longest", order)
        .select(
            "doc_id",
            F.col("periodic.n_words").alias("n_words"),
            F.size(runs).cast("long").alias("n_runs"),
            F.col("longest.start").alias("start"),
            F.col("longest.length").alias("length"),
            F.col("longest.period").alias("period"),
            F.expr("(1000 * longest.length) div longest.period").alias("exponent_milli"),
            F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
            F.sha2(F.col("periodic.collapsed"), 256).alias("collapsed_sha256"),
        )
    )
