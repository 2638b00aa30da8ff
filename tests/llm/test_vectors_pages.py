"""Vectors, pages, toxicity, groups and the pipeline."""

from __future__ import annotations

import gzip
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from holdfast.llm import groups, lattice, toxicity, warc
from tests.llm.fixtures import SCHEMA, docs, empty, prose, rows

FOLDER = "/root/testdata/sf0.001"


def brute_links(rows):
    links = [0] * len(rows)
    label = list(range(len(rows)))
    pairs = []
    for i, (_, la, a) in enumerate(rows):
        for j in range(i):
            _, lb, b = rows[j]
            if la is None or la != lb or not usable(a) or not usable(b) or len(a) != len(b):
                continue
            a_, b_ = (np.array(v) / max(map(abs, v)) for v in (a, b))  # as products overflow
            cos = np.dot(a_, b_) / (np.linalg.norm(a_) * np.linalg.norm(b_))
            if cos >= 0.98:
                pairs.append((i, j))
                links[i] += 1
                links[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                changed = True
    return links, label


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_lattice_dedup_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for group in range(30):
        centre = rng.normal(size=16)
        for _ in range(rng.integers(1, 9)):
            noise = rng.normal(size=16) * rng.choice([0.0, 0.05, 0.1, 0.2])
            rows.append([None, group % 3, [float(x) for x in centre + noise]])
    rows += [[None, 1, list(rows[0][2])], [None, None, list(rows[0][2])], [None, 1, None]]
    rows += [[None, 1, [0.0] * 16], [None, 1, [float("nan")] * 16], [None, 1, [None] * 16]]
    rows += [[None, 1, [1.0, 2.0]], [None, 1, [2.0, 4.0]], [None, 1, []]]
    rows += [[None, 2, [1e-300, 0.0]], [None, 2, [1e300, 0.0]], [None, 2, [float("inf"), 0.0]]]
    for n, row in enumerate(rows):
        row[0] = n
    frame = spark.createDataFrame(
        [(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, cell string"
    ).repartition(4)
    links, label = brute_links(rows)
    for cells_as in (None, *lattice.SETTINGS[1:]):
        found = lattice.near_vectors(frame, cells_as=cells_as).collect()
        got = {r.vec_id: r for r in found}
        assert len(got) == len(found) == len(rows)
        for n in range(len(rows)):
            assert got[n].n_links == links[n] and got[n].component_id == label[n]
            assert got[n].kept == (label[n] == n)
    assert lattice.near_vectors(frame.limit(0)).count() == 0


def test_lattice_copies_are_counted_not_listed(spark):
    one, two = [1.0] * 8, [1.0] * 7 + [1.01]
    rows = [(i, 0, one) for i in range(500)] + [(500 + i, 0, two) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = lattice.near_vectors(frame).collect()
    assert {r.n_links for r in got} == {799} and {r.component_id for r in got} == {0}


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 8)) * 2
    near = lattice.nearest_lattice_point(x)
    least = ((x - near) ** 2).sum(axis=1)
    for step in lattice.STEPS:
        assert (((x - near - step) ** 2).sum(axis=1) >= least - 1e-9).all()
    twice = np.rint(2 * near)
    assert (twice == 2 * near).all() and (twice.sum(axis=1) % 4 == 0).all()
    assert len(lattice.STEPS) == 240


def cells_of(setting, vectors):
    made = lattice.Cells(
        vectors.shape[1], setting.tables, setting.probes, setting.scale, lattice.SEED, setting.blocks
    )
    return made.of(vectors)


@pytest.mark.parametrize("setting", lattice.SETTINGS)
def test_lattice_recall_at_the_threshold(setting):
    rng = np.random.default_rng(4)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    u = rng.normal(size=(4000, 64))
    u -= (u * a).sum(axis=1)[:, None] * a
    u /= np.linalg.norm(u, axis=1)[:, None]
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * u
    x, y = cells_of(setting, a), cells_of(setting, b)
    met = (x[:, :, :, None] == y[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() >= 0.998


def test_lattice_comparisons_follow_the_rows():
    """Comparisons a row stay few from 2,000 to 32,000 random rows of one label."""
    rng = np.random.default_rng(5)
    for count in (2_000, 8_000, 32_000):
        unit = lattice.unit_rows(rng.normal(size=(count, 64)))
        cells = cells_of(lattice.setting_for(count), unit).reshape(count, -1)
        _, sizes = np.unique(np.sort(cells, axis=1).ravel(), return_counts=True)
        assert (sizes * (sizes - 1) // 2).sum() / count <= 8, count


def test_lattice_links_do_not_hang_on_the_number_of_rows(spark):
    """A label of many vectors beside them changes nothing for the others."""
    assert {lattice.setting_for(n) for n in (0, 100, 10_000, 10**8)} == {lattice.DEFAULT}
    rng = np.random.default_rng(9)
    few = [(i, 0, rng.normal(size=4).tolist()) for i in range(150)]
    many = [(1000 + i, 1, rng.normal(size=16).tolist()) for i in range(8_300)]
    found = []
    for rows in (few, few + many):
        frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
        got = lattice.near_vectors(frame).where("vec_id < 1000").collect()
        found.append(sorted(map(tuple, got)))
    assert found[0] == found[1]


def test_lattice_cells_are_the_same_in_any_batch():
    unit = lattice.unit_rows(np.random.default_rng(6).normal(size=(300, 64)))
    for setting in lattice.SETTINGS:
        whole = cells_of(setting, unit)
        for at in range(0, 300, 7):
            assert (cells_of(setting, unit[at : at + 1]) == whole[at]).all()


def test_large_groups_are_cut_into_blocks(spark):
    frame = spark.range(100).select(F.lit(1).alias("key"), F.col("id").alias("member"))
    frame = frame.union(spark.sql("SELECT 2, 7L"))
    got = groups.blocks_of(frame, "key", "member", 30).collect()
    met = set()
    blocks = {}
    for r in got:
        blocks.setdefault((r.key, r.low, r.high), []).append(r)
    for (key, low, high), members in blocks.items():
        for a in members:
            for b in members:
                if key == 1 and a.member < b.member and (low == high or a.own != b.own):
                    assert (a.member, b.member) not in met
                    met.add((a.member, b.member))
    assert len(met) == 100 * 99 // 2
    assert [r.member for r in got if r.key == 2] == [7]


def test_components(spark):
    rng = random.Random(1)
    nodes = 300
    edges = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(220)]
    edges += [(400 + i, 401 + i) for i in range(60)]  # a path
    edges += [(1000, 1001 + i) for i in range(200)]  # a star
    edges += [(5, 5), (None, 3)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in groups.components(frame).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert got == {n: find(n) for n in parent}
    assert groups.components(frame.limit(0)).count() == 0


# WARC


def page_rows():
    big = "<p>" + "ünïcode text & more " * 9000 + "</p>"
    return [
        (0, "http://a/1", "<html>" + "x" * 200),
        (1, None, "<html>" + "x" * 200),
        (2, "http://a/\r\nX: y", big),
        (3, "http://a/3", None),
        (4, "http://a/4", ""),
        (5, "http://a/5", "tiny"),
        (6, "http://a/6", "tiny"),
        (7, "http://a/7", big),
        (8, "http://a/8", "WARC/1.1\r\n\r\n0\r\n\r\n" * 30),
        (9, "http://a/9", "y" * 99),
        (10, "http://a/9", "y" * 99),
        (11, "http://a/b", "é" * 50),
        (12, "http://a/b", "é" * 50),
        (13, "http://a/c", "repeated row " * 2000),
        (13, "http://a/c", "repeated row " * 2000),
        (None, "http://a/d", "<html>" + "x" * 200),
        (None, "http://a/e", "only without id " * 30),
    ]


def test_archives_round_trip(spark, tmp_path):
    rows = page_rows()
    schema = "page_id long, url string, html string, digest string, records string"
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], schema).repartition(3)
    path = str(tmp_path / "warc")
    warc.write_archives(frame, path)
    got = warc.read_archives(spark, path).collect()
    first = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = min(page, first.get(html, page))
    want = Counter()
    for page, _, html in rows:
        other = html in first and first[html] != page
        want[page, "revisit" if other else "response", first[html] if other else None,
             None if other else (html or "").encode()] += 1
    assert Counter((r.page_id, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload is not None else None) for r in got) == want  # noqa: E501
    for r in got:
        if r.record_type == "revisit":
            assert r.declared_bytes >= 100
    empty_path = str(tmp_path / "none")
    warc.write_archives(frame.limit(0), empty_path)
    assert warc.read_archives(spark, empty_path).count() == 0


def test_broken_segments_have_no_payload():
    made = warc.records(3, 1, "http://a", "z" * 40_000, "00", 40_000, None)
    data = b"".join(m.encode() + b"\r\n\r\n" for m in made)
    parts = []
    for headers, begin, end in warc.parsed(data):
        total = headers.get("WARC-Segment-Total-Length")
        parts.append(
            {
                "segment": int(headers["WARC-Segment-Number"]),
                "total": total and int(total),
                "block": data[begin:end],
            }
        )
    assert len(parts) == 3 and warc.reassembled(parts) == b"z" * 40_000
    assert warc.reassembled(parts[:-1]) is None
    assert warc.reassembled([parts[0], parts[2]]) is None
    parts[2]["total"] += 1
    assert warc.reassembled(parts) is None
    assert warc.dechunked(b"3\r\nabc\r\n0\r\n\r\n") == b"abc"
    assert warc.dechunked(b"4\r\nabc\r\n0\r\n\r\n") is None and warc.dechunked(b"") is None


FOREIGN = (
    b"WARC/1.0\r\nwarc-type: warcinfo\r\ncontent-length: 5\r\n\r\nhello\r\n\r\n"
    b"WARC/1.0\r\nWARC-TYPE:response\r\nWarc-Record-Id: <urn:a>\r\nX-Note: one\r\n  two\r\n"
    b"no colon here\r\nWARC-Payload-Digest: sha1:ABC\r\nWARC-Target-URI: http://x/\r\n /y\r\n"
    b"content-LENGTH: 24\r\n\r\nHTTP/1.0 200 OK\r\n\r\nbody!\r\n\r\n"
    b"WARC/0.18\nWARC-Type: resource\nContent-Length: 3\n\nabc\n\n"
    b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 999999\r\n\r\nshort\r\n\r\n"
    b"WARC/1.1\r\nWARC-Type: continuation\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    b"WARC/1.1\r\nWARC-Type: revisit\r\nContent-Length: 0\r\nX-Page-ID: many\r\n\r\n\r\n\r\n"
)


def test_archives_of_others_are_read(spark, tmp_path):
    members = [m.encode() + b"\r\n\r\n" for m in warc.records(1, 7, "u", "q" * 40_000, "00", 1, None)]
    packed = gzip.compress(members[0]) + gzip.compress(members[1])
    (tmp_path / "a.warc").write_bytes(FOREIGN)
    (tmp_path / "b.warc.gz").write_bytes(packed)
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(members[2]) + gzip.compress(b"lost")[:-9])
    (tmp_path / "d.warc").write_bytes(b"")
    got = Counter(
        (r.page_id, r.uri, r.record_type, r.declared_digest, r.payload and bytes(r.payload))
        for r in warc.read_archives(spark, str(tmp_path)).collect()
    )
    assert got == Counter(
        {
            (None, "http://x/ /y", "response", "sha1:ABC", b"body!"): 1,
            (None, None, "resource", None, b"abc"): 1,
            (None, None, "damaged", None, None): 3,
            (None, None, "revisit", None, None): 1,
            (7, "u", "response", "00", b"q" * 40_000): 1,
        }
    )


def test_revisits_name_their_record(spark, tmp_path):
    same, twice = "s" * 50_000, "t" * 200
    rows = [(1, "u1", same), (2, "u2", same), (3, "u3", same), (4, "v", twice), (4, "v", twice),
            (5, "w", twice)]
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    ids, refers = {}, Counter()
    for file in (tmp_path / "warc").glob("*.gz"):
        for headers, _, _ in warc.parsed(gzip.decompress(file.read_bytes())):
            assert ids.setdefault(headers["WARC-Record-ID"], headers) is headers
            if headers["WARC-Type"] == "revisit":
                at = headers.get("WARC-Refers-To"), headers.get("WARC-Refers-To-Target-URI")
                refers[headers["X-Page-ID"], headers["X-Refers-To-Page-ID"], *at] += 1
    name = warc.record_id(0, 1, hashlib.sha256(same.encode()).hexdigest())
    assert refers == {("2", "1", name, "u1"): 1, ("3", "1", name, "u1"): 1, ("5", "4", None, None): 1}
    assert ids[name]["WARC-Type"] == "response" and ids[name]["X-Page-ID"] == "1"


# Toxicity


def toxic_documents(spark):
    rng = random.Random(3)
    bad = ["zorgle", "quimby", "farnok"]
    rows, labels = [], []
    for i in range(400):
        words = prose(1000 + i, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), "en", "a", 1, *["x"] * 16))
        labels.append((i, 1, int(toxic), "x"))
    labels += [(None, 1, 1, "x"), (3, 1, None, "x"), (999_999, 1, 1, "x")]
    return (
        spark.createDataFrame(rows, SCHEMA),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"),
    )


def test_obfuscated_words_are_restored_and_scored(spark):
    frame, labels = toxic_documents(spark)
    model = toxicity.fit(frame, labels)
    decoder = toxicity.Decoder(model.language)
    for noisy in ("z0rgl3", "qu1mby!", "f a r n o k", "z.o.r.g.l.e", "farnooooook", "f@rn0k"):
        assert decoder.restore(noisy).strip(" !") in ("zorgle", "quimby", "farnok"), noisy
    test = spark.createDataFrame(
        [
            (1, prose(7, 50) + " z0rgl3 and f a r n o k"),
            (2, prose(8, 50) + " zorgle"),
            (3, prose(9, 50)),
            (4, None),
            (5, ""),
            (6, "1337 $$$ *** 日本語"),
        ],
        "doc_id long, text string",
    )
    got = {r.doc_id: r.toxicity.score for r in toxicity.score(test, model).collect()}
    assert got[1] > 0.5 and got[2] > 0.5
    assert all(got[i] < 0.5 for i in (3, 4, 5, 6)) and got[4] == got[5]


def test_toxicity_without_labels(spark):
    frame, labels = toxic_documents(spark)
    for some in (labels.limit(0), labels.where("toxic = 0")):
        model = toxicity.fit(frame, some)
        assert {r.toxicity.score < 0.5 for r in toxicity.score(docs(spark), model).collect()} == {True}
    assert toxicity.score(empty(spark), model).count() == 0


def test_fit_takes_one_row_of_each_labelled_id(spark, monkeypatch):
    frame, labels = toxic_documents(spark)
    ids = [r._id for r in toxicity.labelled_sample(labels, 10).collect()]
    again = frame.where(F.col("doc_id") == ids[0])
    again = again.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(50))))
    again = again.withColumn("text", F.concat("text", F.when(F.col("_n") > 25, F.lit(" more"))))
    many = frame.unionByName(again.drop("_n")).repartition(5)
    seen = []
    fitted = toxicity.fit_logistic
    monkeypatch.setattr(toxicity, "fit_logistic", lambda x, y: (seen.append(len(y)), fitted(x, y))[1])
    toxicity.fit(many, labels)
    sample = toxicity.labelled_sample(labels, toxicity.FIT_ROWS)
    assert seen == [sample.where("_id < 400").count()]
    rows = toxicity.labelled_texts(many, labels, 10).collect()
    assert 9 <= len(rows) <= 10 and all(r.text for r in rows)


def held_out_rates(rows):
    """Share of toxic rows found, and of clean rows called toxic."""
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    return sum(toxic) / len(toxic), sum(clean) / len(clean)


def test_held_out_recall_and_false_alarms(spark):
    got = entry.queries()["op6_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    recall, alarms = held_out_rates(rows)
    assert recall >= 0.9 and alarms <= 0.01


def every_reading(decoder, noisy):
    """All paths through the lattice with their scores."""
    edges = decoder.edges(noisy)
    todo, found = [(0, "", 0.0)], []
    while todo:
        at, read, cost = todo.pop()
        if at == len(noisy):
            found.append((read, cost))
        else:
            todo += [(to, read + more, cost + price) for to, more, price in edges[at]]
    scores = {}
    for read, cost in found:
        state, total = 0, -cost
        for c in read + " ":
            symbol = 0 if c == " " else ord(c)
            total += decoder.model.log_p(state << 21 | symbol)
            state = (state & (1 << 21) - 1) << 21 | symbol
        scores[read] = max(total, scores.get(read, -1e300))
    return scores


def test_decoding_is_the_best_of_all_readings(spark):
    frame = spark.createDataFrame(
        [(1, "the silly idiot is a bad person"), (2, "Это плохой дурак"), (3, "łódź œuvre straße")],
        "doc_id long, text string",
    )
    decoder = toxicity.Decoder(toxicity.language_model(frame))
    rng = random.Random(2)
    words = ["id10t", "b@d", "s1lly", "pеrson", "дур@@к", "łó0dź", "1", "++", "aaa", "ddduuurrr"]
    words += ["".join(rng.choice("abdiot0146$@!|дк") for _ in range(rng.randint(1, 8))) for _ in range(150)]
    for noisy in words:
        scores = every_reading(decoder, noisy)
        assert scores[decoder.decode(noisy)] == pytest.approx(max(scores.values()), abs=1e-9), noisy
    assert decoder.decode("id10t") == "idiot" and decoder.decode("дуууурак") == "дурак"


def test_letters_of_every_script_are_counted(spark):
    texts = ["Ab ab ÉÉ", "日本語 日本", "ab\u0301c", None, "", "12 ªº"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    model = toxicity.language_model(frame)
    want: dict = {}
    for t in texts:
        points = [ord(c) if toxicity.is_letter(c) else 0 for c in (t or "").lower()]
        points = [0, 0, *points, 0, 0]
        for abc in zip(points, points[1:], points[2:]):
            if any(abc):
                want[toxicity._packed(*abc)] = want.get(toxicity._packed(*abc), 0) + 1
    assert {k: n for k, n in model.three.items() if k} == want


def test_toxic_words_in_other_scripts(spark):
    """Words beyond Latin-1 carry evidence, with blanks between them and without."""
    bad = {"ru": "тупица негодяй", "pl": "głupiec łajdak", "ja": "馬鹿野郎だね", "hi": "मूर्ख गधा"}
    good = {"ru": "добрый день", "pl": "dzień łąka żółw", "ja": "今日は良い天気", "hi": "अच्छा दिन"}
    source, labels = [], []
    for i in range(480):
        lang, toxic = list(bad)[i % 4], i // 4 % 3 == 0
        text = f"{good[lang]} {i} {(bad if toxic else good)[lang]} {good[lang]}"
        source.append((i, text))
        labels.append((i, int(toxic)))
    frame = spark.createDataFrame(source, "doc_id long, text string").repartition(4)
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = {r.doc_id: r.toxicity.score for r in toxicity.score(frame, model).collect()}
    for i, toxic in labels:
        assert (scores[i] >= 0.5) == bool(toxic), source[i]


def test_toxicity_of_awkward_rows(spark):
    """Null, empty, very long and repeated rows, clashing names, labels that repeat an id."""
    frame, _ = toxic_documents(spark)
    made = [(r[0], 1, int(r[0] == 2), "x") for r in rows() if r[0] is not None]
    labels = spark.createDataFrame([*made, (None, 1, 1, "x"), (2, 1, 0, "y")],
                                   "doc_id long, quality int, toxic int, text string")
    model = toxicity.fit(docs(spark), labels)
    got = toxicity.score(docs(spark), model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows())
    assert all(0 <= r.toxicity.score <= 1 for r in got)
    assert len({r.toxicity.score for r in got if r.doc_id in (3, 4, 5, None)}) >= 1
    assert toxicity.score(empty(spark), model).count() == 0
    assert toxicity.fit(empty(spark), labels).lexicon == {}


# Pipeline


def test_pipeline_stages(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    columns = frame.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in frame.select("doc_id").collect()}
        frame = stage(spark, frame, FOLDER)
        assert frame.columns == columns, name
        after = [r.doc_id for r in frame.select("doc_id").collect()]
        assert after and set(after) <= before and len(after) == len(set(after)), name


def test_pipeline_on_awkward_rows(spark):
    from holdfast.session import store

    for frame in (docs(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            frame = store(stage(spark, frame, FOLDER), name)
        assert frame.columns[:2] == ["doc_id", "piece"]


def test_pipeline_against_a_brute_force_chain(spark, tmp_path):
    from holdfast.llm.mixing import BLOCK_WORDS, mix
    from holdfast.session import store
    from tests.llm.test_documents import brute_quality, simhash_kept

    rng, key, rest = random.Random(21), "q7Zr2Xw9Lk4Vb8Nt3Ms6Pd1Hf5", ("en",)
    source = []
    for n in range(90):
        words = [f"w{rng.randrange(5000)}" for _ in range(120)]
        if n % 9 == 0:
            words[60] = f"token={key}"
        if n % 10 == 9:
            words = words[:30]  # too short
        source.append((3 * n, " ".join(words), *rest, "ab"[n % 3 == 0], 1))
        if n % 4 == 0:  # a near copy, and a text that only shares its first half
            source.append((3 * n + 1, " ".join([*words[:-1], "end"]), *rest, "a", 1))
            half = [f"v{rng.randrange(5000)}" for _ in range(60)]
            source.append((3 * n + 2, " ".join([*words[:60], *half]), *rest, "b", 1))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(source, schema)
    frame.write.parquet(f"{tmp_path}/documents.parquet")

    good = [r for r in source if not brute_quality(r[1])[-1]]
    kept = simhash_kept(good)
    assert 60 < len(kept) < len(good) < len(source)
    want = {r[0]: r[1].replace(f"token={key}", "token=[secret]") for r in good if r[0] in kept}
    docs_ = frame
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs_, before = store(stage(spark, docs_, str(tmp_path)), name), docs_
    assert {r.doc_id: r.text for r in before.collect()} == want
    assert before.count() == len(want)

    mixed = {r.doc_id: r for r in docs_.collect()}
    assert set(mixed) <= set(want)
    goal = {r["source"]: r["target"] for r in mix(before)[1].collect()}
    for name, target in goal.items():
        total = sum(len(r.text.split()) for r in mixed.values() if r.source == name)
        assert abs(total - target) <= 1.5 * BLOCK_WORDS

    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == set(mixed)
    for doc_id in mixed:
        at = 0
        for r in sorted((r for r in pieces if r.doc_id == doc_id), key=lambda r: r.piece):
            assert r.start == at
            at += r.length
        assert at > len(mixed[doc_id].text.split())


@pytest.mark.parametrize("name", ["op2_sharding", "op3_embedding_near_dedup", "op10_warc"])
def test_sql_is_given_where_it_can_be(name):
    assert name in entry.oracle_sql()
