"""Source divergences against exact arithmetic in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from holdfast.llm import divergence
from tests.llm.fixtures import docs, empty, rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(source, least, top):
    lower = {chr(c): chr(c + 32) for c in range(65, 91)}
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, name in source:
        terms = TERM.findall("".join(lower.get(c, c) for c in text or ""))
        groups.add((lang or "", name or ""))
        counts[lang or "", name or ""].update(terms)
        seen[lang or ""].update(set(terms))
    out = []
    for lang, name in groups:
        kept = [t for t, n in seen[lang].items() if n >= least]
        own = {s: counts[lang, s] for g, s in groups if g == lang}
        whole = sum(own.values(), Counter())

        def share(count, term):
            total = sum(count[t] for t in kept)
            return 1 + 10**9 * (count[term] + 5) // (total + 5 * len(kept))

        pairs = [
            (s, sum(abs(share(own[name], t) - share(own[s], t)) for t in kept))
            for s in own
            if s != name
        ]
        terms = [(t, share(own[name], t) - share(whole, t)) for t in kept if own[name][t]]
        terms = [(t, f) for t, f in terms if f > 0]
        for part, found in (("pair", pairs), ("term", terms)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            for rank, (item, value) in enumerate(found, 1):
                if part == "pair" or rank <= top:
                    out.append((lang, name, part, item, value, rank))
    return Counter(out)


def some_documents():
    rng = random.Random(12)
    letters = ["Ab", "cd", "Éa", "ÀB", "日本", "x1y", "zz", "q", "Qu", "straße", "a_b"]
    made = [
        (
            " ".join(rng.choices(letters, k=rng.randrange(30))),
            rng.choice(["en", "fr", None, ""]),
            rng.choice(["s1", "s2", "s2", "s2", "ß", None]),
        )
        for _ in range(150)
    ]
    made += [(None, "de", "alone"), ("", "en", "silent"), ("\x00\x7f 12", "it", "a"), ("b", "it", "b")]
    return made * 2  # repeated rows count twice


@pytest.mark.parametrize("cells", [divergence.CELLS, (1, 7)])
@pytest.mark.parametrize("least, top", [(5, 4), (30, 50)])
def test_matches_exact_arithmetic(spark, cells, least, top):
    source = some_documents()
    frame = spark.createDataFrame(
        [(*r, "x", 1) for r in source], "body string, l string, s string, term string, n long"
    ).repartition(3)
    names = {"text": "body", "lang": "l", "source": "s"}
    got = divergence.divergences(frame, least_docs=least, top=top, cells=cells, **names)
    assert Counter(map(tuple, got.collect())) == brute(source, least, top)


def test_small_slices_and_early_flushes(spark):
    source = some_documents()
    frame = spark.createDataFrame(source, "text string, lang string, source string").coalesce(1)

    def counts(**sizes):
        partial = divergence.partial_counts(frame, **sizes)
        return Counter(map(tuple, divergence.kept_counts(partial, 4).collect())), partial.count()

    want, rows = counts()
    again, more = counts(slice_bytes=200, held_rows=10)
    assert again == want and more > rows


def test_shares_of_huge_counts_are_exact(spark):
    from pyspark.sql import functions as F

    n, total, terms = 7 * 10**12 + 3, 9 * 10**13 + 7, 12345
    made = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms))).first()[0]
    assert made == 1 + 10**9 * (n + 5) // (total + 5 * terms)


def test_awkward_rows(spark):
    got = divergence.divergences(docs(spark), least_docs=2, top=5)
    want = brute([(r[1], r[2], r[3]) for r in rows()], 2, 5)
    assert Counter(map(tuple, got.collect())) == want
    assert divergence.divergences(empty(spark)).count() == 0
