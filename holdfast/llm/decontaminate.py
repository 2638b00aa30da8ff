"""Benchmark decontamination: training words streamed through a suffix automaton of the items."""

from __future__ import annotations

import pickle
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.batches import annotate, column, free_name
from holdfast.llm.rows import documents, row_digest
from holdfast.llm.text import encoded
from holdfast.session import store

#: Consecutive item words that make an occurrence; shorter items count as a whole.
WINDOW = 10
#: A document with a larger share of its words inside occurrences is rejected.
MOST_HIT = 0.5
#: Item words in one automaton, about 150 bytes each: it bounds what is broadcast.
BLOCK_WORDS = 1 << 20
#: Words of an item that are kept together; longer items are cut, ``WINDOW - 1`` words shared.
PIECE_WORDS = 1 << 14

#: Words hold ASCII letters and digits and all that is beyond ASCII.
_KEPT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def normalised(text: str | None) -> list[bytes]:
    return encoded(text or "").translate(_NORMAL).split()


class Automaton:
    """All stretches of the texts added, as states; a state stands for the stretches that end
    at the same places, of ``size[link] + 1`` to ``size`` words.

    ``edges`` leads from ``state * width + word`` to the next state.  After ``finish``,
    ``window`` has the state of a state's last ``WINDOW`` words (0 if it has fewer),
    ``classes`` the texts that hold those words, ``whole`` the text that a state spells
    from beginning to end, if it is shorter than a window, and ``shorter`` the nearest such
    state among a state and those it links to.
    """

    def __init__(self, texts: Sequence[Sequence[bytes]], window: int = WINDOW):
        self.window_words = window
        self.number = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
        self.width = max(1, len(self.number))
        self.edges: dict[int, int] = {}
        self.link, self.size = [0], [0]
        self._out: list[list[int]] = [[]]  # words that lead on, needed to copy a state
        coded = [[self.number[w] for w in t] for t in texts]
        for words in coded:
            last = 0
            for word in words:
                last = self._extended(last, word)
        del self._out
        self._finish(coded)

    def _state(self, size: int, link: int, out: list[int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self._out.append(out)
        return len(self.size) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The part of ``target`` whose stretches end in ``state`` and ``word``, as a state."""
        edges, width = self.edges, self.width
        part = self._state(self.size[state] + 1, self.link[target], [*self._out[target]])
        for w in self._out[target]:
            edges[part * width + w] = edges[target * width + w]
        self.link[target] = part
        while edges.get(state * width + word) == target:
            edges[state * width + word] = part
            if not state:
                break
            state = self.link[state]
        return part

    def _extended(self, last: int, word: int) -> int:
        edges, width = self.edges, self.width
        target = edges.get(last * width + word)
        if target is not None:  # the stretch is there already, from another text
            if self.size[target] == self.size[last] + 1:
                return target
            return self._split(last, word, target)
        made = self._state(self.size[last] + 1, 0, [])
        state = last
        while state * width + word not in edges:
            edges[state * width + word] = made
            self._out[state].append(word)
            if not state:
                return made
            state = self.link[state]
        target = edges[state * width + word]
        if self.size[target] != self.size[state] + 1:
            target = self._split(state, word, target)
        self.link[made] = target
        return made

    def _finish(self, coded: list[list[int]]) -> None:
        n, link, size = self.window_words, self.link, self.size
        self.window, self.shorter = [0] * len(size), [0] * len(size)
        self.whole: dict[int, int] = {}
        classes: dict[int, dict[int, None]] = {}
        for number, words in enumerate(coded):
            if 0 < len(words) < n:
                state = 0
                for word in words:
                    state = self.edges[state * self.width + word]
                self.whole[state] = number
        for state in sorted(range(1, len(size)), key=size.__getitem__):
            if size[state] >= n:
                up = link[state]
                self.window[state] = self.window[up] if size[up] >= n else state
            self.shorter[state] = state if state in self.whole else self.shorter[link[state]]
        for number, words in enumerate(coded):
            state = 0
            for at, word in enumerate(words):
                state = self.edges[state * self.width + word]
                if at + 1 >= n:
                    classes.setdefault(self.window[state], {})[number] = None
        self.classes = {state: tuple(found) for state, found in classes.items()}

    def spans(self, words: Sequence[bytes]) -> tuple[list[list[int]], set[int]]:
        """Stretches of words, ``[first, end)`` in order and apart, that are inside an
        occurrence, and the texts that occur.

        The length matched so far is that of the longest stretch of any text which ends at
        the present word.
        """
        edges, width, link, size = self.edges, self.width, self.link, self.size
        window, shorter, whole, n = self.window, self.shorter, self.whole, self.window_words
        state = length = 0
        spans: list[list[int]] = []
        found: set[int] = set()
        seen: set[int] = set()
        for at, word in enumerate(map(self.number.get, words)):
            if word is None:
                state = length = 0
                continue
            target = edges.get(state * width + word)
            if target is None:
                while target is None and state:
                    state = link[state]
                    target = edges.get(state * width + word)
                length = size[state]
            state = target  # the first state has an edge for every word known
            length += 1
            if length >= n:
                first = at + 1 - length
                if window[state] not in seen:
                    seen.add(window[state])
                    found.update(self.classes[window[state]])
            else:
                first = at + 1
            short = shorter[state]
            if short:
                if size[short] > length:  # longer than what is matched of it
                    short = shorter[link[short]]
                if short:
                    first = min(first, at + 1 - size[short])
                    while short and short not in seen:
                        seen.add(short)
                        found.add(whole[short])
                        short = shorter[link[short]]
            if first <= at:
                while spans and spans[-1][0] >= first:
                    spans.pop()
                if spans and spans[-1][1] >= first:
                    spans[-1][1] = at + 1
                else:
                    spans.append([first, at + 1])
        return spans, found


_ITEMS = T.StructType([T.StructField("pieces", T.ArrayType(T.StringType(), False), False)])
_BUILT = T.StructType(
    [
        T.StructField("block", T.IntegerType(), False),
        T.StructField("data", T.BinaryType(), False),
    ]
)


def automata(
    items: DataFrame,
    *,
    item_id: str = "item_id",
    text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, int]:
    """A stored table of ``block`` and ``data``, the automaton of the block's items with their
    ids, and the number of blocks.

    Items of equal words are one text with all their ids.  Blocks are dealt by the hash of the
    text to hold about ``block_words`` words; each is built by one task.  Null ids name
    nothing but their items' words count; items without words are left out.
    """

    def start():
        def cut(value):
            words = normalised(value)
            step = max(PIECE_WORDS, window) - window + 1
            starts = range(0, max(1, len(words) - window + 1), step)
            return ([(b" ".join(words[a : a + step + window - 1])).decode() for a in starts],)

        return lambda texts: [cut(t) for t in texts]

    cuts = annotate(items, [text], [item_id], "cut", _ITEMS, start)
    cuts = cuts.select(
        column(item_id).cast("string").alias("id"), F.explode("cut.pieces").alias("words")
    ).where("words <> ''")
    classes = store(
        cuts.groupBy("words").agg(F.sort_array(F.collect_set("id")).alias("ids")), "items"
    )
    total = classes.agg(F.sum(F.size(F.split("words", " ")))).first()[0] or 0
    count = max(1, -(-total // block_words))
    dealt = classes.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(count)).cast("int"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("words")
        made = Automaton([w.encode().split(b" ") for w in group["words"]], window)
        ids = [tuple(x) for x in group["ids"]]
        data = pickle.dumps((made, ids), pickle.HIGHEST_PROTOCOL)
        return pd.DataFrame({"block": [int(group["block"].iloc[0])], "data": [data]})

    return store(dealt.groupBy("block").applyInPandas(build, _BUILT), "automata"), count


_SPAN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "end")])
_STRETCH = T.StructType([T.StructField(n, T.LongType(), False) for n in ("first", "stop")])
FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("hit", T.ArrayType(_STRETCH, False), False),
        T.StructField("items", T.ArrayType(T.StringType(), False), False),
        T.StructField("spans", T.ArrayType(_SPAN, False), False),
    ]
)


def _places(text: str, stretches: list) -> list[tuple[int, int]]:
    """Stretches of words as code points of the text, end exclusive."""
    if not stretches:
        return []
    words = [m.span() for m in _KEPT.finditer(text)]
    return [(words[a][0], words[b - 1][1]) for a, b in stretches]


def _scan(docs: DataFrame, text: str, carry: Sequence[str], result: str, shared) -> DataFrame:
    def start():
        made, ids = (None, None) if shared is None else pickle.loads(shared.value)

        def compute(texts):
            rows = []
            for value in texts:
                words = normalised(value)
                stretches, found = made.spans(words) if made else ([], set())
                items = sorted({i for number in found for i in ids[number]})
                places = _places(value, stretches) if stretches else []
                rows.append((len(words), [*map(tuple, stretches)], items, places))
            return rows

        return compute

    return annotate(docs, [text], carry, result, FIELDS, start)


def _merged(stretches):
    """A document's stretches from several blocks, sorted, as stretches that lie apart."""
    kind = "array<struct<first:bigint,stop:bigint>>"
    return F.expr(
        f"""reduce({stretches}, CAST(array() AS {kind}), (done, s) ->
        IF(size(done) > 0 AND element_at(done, -1).stop >= s.first,
           concat(slice(done, 1, size(done) - 1), array(named_struct(
               'first', element_at(done, -1).first,
               'stop', greatest(element_at(done, -1).stop, s.stop)))),
           concat(done, array(s))))"""
    )


def find_overlaps(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    result: str = "overlap",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``carry`` and a struct: ``n_words``; ``hit``, the stretches of words (from 0, end
    exclusive) inside occurrences; ``items``, the ids as strings, in order, of the items of
    which something occurs; ``spans``, the stretches as code points of the text.

    An occurrence is ``window`` consecutive words of an item, or a whole item of fewer words.
    Words are ASCII letters (in either case), digits and what is beyond ASCII.  Null and empty
    texts have no words and no hits, nor does anything if there are no items.  Rows are
    scanned alone: repeated rows repeat, an empty table gives an empty one.

    One automaton of at most about ``block_words`` item words is broadcast at a time.  More
    items are scanned in so many passes over the texts, whose findings, kept only for
    documents with hits, are joined by the rows' digests at the end.
    """
    spark = docs.sparkSession
    built, count = automata(
        items, item_id=item_id, text=item_text, window=window, block_words=block_words
    )

    def shared(block: int):
        row = built.where(F.col("block") == block).first()
        return spark.sparkContext.broadcast(bytes(row.data)) if row else None

    if count == 1:
        return _scan(docs, text, carry, result, shared(0))
    key = free_name(docs, "_digest")
    keyed = docs.withColumn(key, row_digest(text))
    parts = None
    for block in range(count):
        found = _scan(keyed, text, [key], "found", shared(block))
        found = found.where(F.size("found.hit") > 0).dropDuplicates([key])
        found = store(found.select(F.col(key).alias("key"), "found.hit", "found.items"), "hits")
        parts = found if parts is None else parts.unionByName(found)
    hits = parts.groupBy("key").agg(
        F.array_sort(F.flatten(F.collect_list("hit"))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    hits = store(hits.select("key", _merged("all").alias("hit"), "items"), "hits")
    joined = keyed.join(hits.withColumnRenamed("key", "_key").select(
        "_key", F.col("hit").alias("_hit"), F.col("items").alias("_items")
    ), column(key) == F.col("_key"), "left")
    return _placed(joined, text, carry, result)


def _placed(joined: DataFrame, text: str, carry: Sequence[str], result: str) -> DataFrame:
    def start():
        def compute(texts, hits, items):
            rows = []
            for value, hit, names in zip(texts, hits, items):
                stretches = [(s["first"], s["stop"]) for s in hit or ()]
                count = len(normalised(value))
                rows.append((count, stretches, names or [], _places(value or "", stretches)))
            return rows

        return compute

    return annotate(joined, [text, "_hit", "_items"], carry, result, FIELDS, start)


def remove_overlaps(
    docs: DataFrame,
    items: DataFrame,
    *,
    most_hit: float = MOST_HIT,
    **options,
) -> DataFrame:
    """The documents with all their columns, the spans of occurrences cut out of the texts,
    without those of which more than ``most_hit`` of the words lie inside occurrences."""
    text, name = options.get("text", "text"), free_name(docs, "_overlap")
    found = find_overlaps(docs, items, carry=docs.columns, result=name, **options)
    overlap = column(name)
    hit = F.aggregate(overlap["hit"], F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])
    found = found.where(hit <= F.lit(most_hit) * overlap["n_words"])
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(overlap["spans"], lambda s: s["end"]))
    starts = F.concat(
        F.transform(overlap["spans"], lambda s: s["start"]),
        F.array(F.length(column(text)).cast("long")),
    )
    parts = F.zip_with(
        ends, starts, lambda a, b: F.substring(column(text), (a + 1).cast("int"), (b - a).cast("int"))
    )
    clean = F.when(F.size(overlap["spans"]) > 0, F.array_join(parts, "")).otherwise(column(text))
    return found.withColumn(text, clean).select(*map(column, docs.columns))


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    o = F.col("overlap")
    n_hit = F.aggregate(o["hit"], F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])
    return find_overlaps(documents(spark, sf_dir), items).select(
        "doc_id",
        o["n_words"].alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(o["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(o["items"], ","), 256).alias("items_sha256"),
        (F.size(o["hit"]) > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), sized AS (
    SELECT item, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS words
    FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
), docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), places AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS words
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM docs, (SELECT DISTINCT n FROM sized))
), matched AS (
    SELECT doc_id, n, i, item FROM places JOIN windows USING (n, words)
), hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS place
          FROM (SELECT DISTINCT doc_id, n, i FROM matched))
    GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM matched) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""
