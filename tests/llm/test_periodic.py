"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from holdfast.llm import periodic
from tests.llm.fixtures import docs, empty, rows

FOLDER = "/root/testdata/sf0.001"


def brute(words, least=6, times=4):
    """Every period, every stretch, and every smaller period tried."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            part = words[i : j + q]
            smaller = any(part[d:] == part[:-d] for d in range(1, q))
            if len(part) >= max(least, times * q) and not smaller:
                found.append((i, len(part), q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rng):
    n, letters = rng.randrange(70), rng.choice([1, 2, 2, 3, 6])
    words = [rng.randrange(letters) for _ in range(n)]
    if words and rng.random() < 0.6:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 4))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        words += [rng.randrange(letters) for _ in range(rng.randrange(12))]
    return words


def test_runs_match_brute_force():
    rng = random.Random(5)
    for _ in range(2500):
        words = some_words(rng)
        got = periodic.find_runs(np.array(words, np.int64))
        assert [tuple(r) for r in got.tolist()] == brute(words), words


def test_texts_searched_together_do_not_touch(monkeypatch):
    monkeypatch.setattr(periodic, "CHUNK_WORDS", 150)
    rng = random.Random(6)
    lists = [list(map(str, some_words(rng))) for _ in range(300)]
    lists += [["x"] * 400, ["a", "b"] * 300, [], ["one"]]
    for words, got in zip(lists, periodic.search([" \n".join(w) for w in lists])):
        runs = brute(words)
        assert got == (len(words), runs, collapsed(words, runs))


def test_other_limits():
    words = [0] * 9 + [1, 2, 3] * 5 + [4]
    got = periodic.find_runs(np.array(words), least_words=10, least_periods=5)
    assert got.tolist() == [[9, 15, 3]]
    with pytest.raises(ValueError):
        periodic.find_runs(np.array(words), least_periods=2)


def test_long_text_with_one_long_period():
    words = np.arange(200_000) % 50_000
    assert periodic.find_runs(words).tolist() == [[0, 200_000, 50_000]]


def test_awkward_rows(spark):
    got = periodic.periodic_runs(docs(spark)).select("doc_id", "periodic.*").collect()
    want = []
    for doc_id, text, *_ in rows():
        words = (text or "").split()
        runs = brute(words) if len(words) < 1000 else None
        want.append((doc_id, len(words), runs and tuple(runs), runs is None or collapsed(words, runs)))
    have = []
    for r in got:
        long = r.n_words >= 1000
        runs = None if long else tuple(map(tuple, r.runs))
        have.append((r.doc_id, r.n_words, runs or None, long or r.collapsed))
    assert Counter(have) == Counter((a, b, c or None, d) for a, b, c, d in want)
    long = next(r for r in got if r.n_words >= 1000)
    assert [r.period for r in long.runs] == [977] and long.runs[0].start == 5
    assert periodic.periodic_runs(empty(spark)).count() == 0


def test_query_against_brute_force(spark):
    got = {r.doc_id: r for r in entry.queries()["op11_periodic_runs"](spark, FOLDER).collect()}
    source = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(source)
    some = 0
    for doc_id, text in source:
        words = (text or "").split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        some += len(runs)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want = (
            len(runs),
            *(best or (None, None, None)),
            best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
        )
        r = got[doc_id]
        assert want == (
            r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256,
            r.collapsed_sha256,
        ), doc_id
    assert some > 10
