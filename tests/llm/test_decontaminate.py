"""Benchmark overlaps against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

from holdfast.llm import decontaminate
from holdfast.llm.decontaminate import Automaton, find_overlaps, remove_overlaps
from tests.llm.fixtures import SCHEMA, docs, empty, prose, rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, words string, ids string, block string"


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(text, items, window):
    """Hit words and the ids of items of which a window occurs, by comparing every place."""
    words, hit, found = words_of(text), set(), set()
    for item, item_text in items:
        own = words_of(item_text)
        n = min(window, len(own))
        wanted = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in wanted:
                hit.update(range(i, i + n))
                if item is not None:
                    found.add(str(item))
    return len(words), frozenset(hit), sorted(found)


def test_automaton_matches_brute_force():
    rng = random.Random(8)
    for _ in range(400):
        letters = "abcdef"[: rng.randint(1, 6)]
        texts = [[rng.choice(letters).encode() for _ in range(rng.randrange(14))] for _ in range(5)]
        window = rng.randint(2, 6)
        automaton = Automaton(texts, window)
        words = [rng.choice(letters + "z").encode() for _ in range(rng.randrange(60))]
        spans, found = automaton.spans(words)
        items = [(i, b" ".join(t).decode()) for i, t in enumerate(texts)]
        _, hit, ids = brute(b" ".join(words).decode(), items, window)
        assert {i for a, b in spans for i in range(a, b)} == hit
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
        # equal texts share a state, whose last one stands for all; the table has them once
        names = {tuple(texts[i]) for i in found}
        assert names == {tuple(texts[int(i)]) for i in ids}


def some_items():
    one, other = prose(1, 90), prose(30, 40)
    return [
        (1, " ".join(one.split()[20:45])),
        (2, " ".join(one.split()[40:60]).upper()),
        (3, "Short, ONE!"),
        (10, "short one"),
        (4, None),
        (5, " ;; "),
        (6, other),
        (6, other),  # a repeated row
        (7, other),  # a copy under another id
        (None, "start of a long text"),
        (8, "façade – 日本語 “quoted”"),
    ]


def frame_of(spark):
    made = [(i, t, "x", "y", "z") for i, t in some_items()]
    return spark.createDataFrame(made, ITEMS)


def result_of(frame):
    found = frame.select("doc_id", "overlap.*").collect()
    return Counter(
        (
            r.doc_id,
            r.n_words,
            frozenset(i for s in r.hit for i in range(s.first, s.stop)),
            tuple(r["items"]),
        )
        for r in found
    )


def test_awkward_rows_in_one_block_and_in_many(spark, monkeypatch):
    items = frame_of(spark)
    want = Counter()
    for doc_id, text, *_ in rows():
        n, hit, ids = brute(text, some_items(), 10)
        want[doc_id, n, hit, tuple(ids)] += 1
    assert sum(bool(hit) for _, _, hit, _ in want) >= 4
    assert result_of(find_overlaps(docs(spark), items)) == want
    assert decontaminate.automata(items, block_words=30)[1] > 2
    assert result_of(find_overlaps(docs(spark), items, block_words=30)) == want
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 12)  # long items in pieces
    assert result_of(find_overlaps(docs(spark), items)) == want
    assert find_overlaps(empty(spark), items).count() == 0
    nothing = find_overlaps(docs(spark), items.where("false"))
    assert nothing.where("size(overlap.hit) > 0").count() == 0 and nothing.count() == len(rows())


def test_spans_are_cut_and_covered_documents_go(spark):
    text = prose(40, 60)
    item = " ".join(text.split()[10:25])
    source = [
        (1, f"Before it — {item.upper()}! After it. {prose(41, 40)}"),
        (2, f"a {item} b"),  # nearly all of it
        (3, prose(42, 30)),
        (4, None),
    ]
    pad = [None] * (len(SCHEMA.fields) - 2)
    frame = spark.createDataFrame([(i, t, *pad) for i, t in source], SCHEMA)
    items = spark.createDataFrame([(1, item, "x", "y", "z")], ITEMS)
    got = {r.doc_id: r.text for r in remove_overlaps(frame, items).collect()}
    assert got == {
        1: f"Before it — ! After it. {prose(41, 40)}",
        3: source[2][1],
        4: None,
    }
    assert remove_overlaps(frame, items).columns == frame.columns
    assert remove_overlaps(docs(spark), items).count() == len(rows())
