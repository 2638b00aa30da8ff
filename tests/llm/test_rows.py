"""Numbers of repeated rows, running sums, and sources by the thousand."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from holdfast.llm import mixing, rows, sharding
from tests.llm import fixtures


def test_large_groups_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(rows, "MOST_EQUAL", 10)
    names = ["a"] * 333 + ["b"] * 11 + ["c"] * 10 + ["d"] + [None] * 3
    frame = spark.createDataFrame([(n, "x") for n in names], "key string, n string").repartition(4)
    frame = frame.withColumn("digest", rows.row_digest("key"))
    got = rows.numbered(frame, "digest", "copy")
    assert got.columns == [*frame.columns, "copy"]
    found = got.select("key", "copy").collect()
    assert Counter(map(tuple, found)) == Counter(
        (k, i) for k, count in Counter(names).items() for i in range(count)
    )
    assert rows.numbered(frame.limit(0), "digest", "copy").count() == 0


def test_copies_are_mixed_and_sharded_in_parts(spark, monkeypatch):
    frame = fixtures.docs(spark)
    many = frame.where("doc_id = 9").crossJoin(spark.range(40).select()).unionByName(frame)
    whole = [mixing.taken_words(*mixing.mix(many)), sharding.shard(many, limit=2_000)]
    whole = [Counter(map(tuple, df.collect())) for df in whole]
    texts = Counter(map(tuple, mixing.mixed_documents(many).select("doc_id", "text").collect()))
    monkeypatch.setattr(rows, "MOST_EQUAL", 5)
    monkeypatch.setattr(mixing, "MOST_EQUAL", 5)
    parted = [mixing.taken_words(*mixing.mix(many)), sharding.shard(many, limit=2_000)]
    assert [Counter(map(tuple, df.collect())) for df in parted] == whole
    again = Counter(map(tuple, mixing.mixed_documents(many).select("doc_id", "text").collect()))
    assert again == texts


def test_running_sums(spark):
    rng = random.Random(4)
    values = [(i, rng.randrange(50), "x") for i in range(3_000)]
    frame = spark.createDataFrame(values, "id long, n int, _part string").repartition(6)
    sums = {"before": F.col("n").cast("long"), "ones": F.lit(1).cast("long")}
    got = rows.running_sums(frame, [F.col("n").desc(), F.col("id")], sums)
    assert got.columns == [*frame.columns, "before", "ones"]
    told = {r.id: (r.before, r.ones) for r in got.collect()}
    total = 0
    for at, (i, n, _) in enumerate(sorted(values, key=lambda v: (-v[1], v[0]))):
        assert told[i] == (total, at)
        total += n
    assert rows.running_sums(frame.limit(0), [F.col("id")], sums).count() == 0


def shared(sizes, weights, share, most):
    """Targets by sharing the excess again until none is above its stop."""
    left, open_ = share * sum(sizes), dict(enumerate(sizes))
    targets = {}
    while open_:
        level = left / sum(weights[i % len(weights)] for i in open_)
        full = [i for i, s in open_.items() if level * weights[i % len(weights)] >= most * s]
        if not full:
            return targets | {i: level * weights[i % len(weights)] for i in open_}
        for i in full:
            targets[i] = most * open_.pop(i)
            left -= targets[i]
    return targets


@pytest.mark.parametrize("count", [1, 7, 2_500])
def test_targets_of_many_sources(spark, count):
    rng = random.Random(count)
    sizes = [int(rng.paretovariate(0.8) * 50) for _ in range(count)]
    names = [f"host{i:06}" for i in range(count - 1)] + [None]
    sized = spark.createDataFrame([*zip(names, sizes)], "source string, size long").repartition(5)
    got = {r.source_no: r for r in mixing.source_targets(sized).collect()}
    want = shared(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.MOST_REPEATS)
    assert [got[i].source for i in range(count)] == names
    for i in range(count):
        assert got[i].target == pytest.approx(want[i], rel=1e-9)
        assert got[i].source_size == sizes[i] and got[i].target <= 2 * sizes[i]


def test_slots_of_many_sources_are_met(spark):
    rng = random.Random(8)
    slots = [rng.choice([0, 1, 3, 40, 900]) for _ in range(400)]
    targets = spark.createDataFrame([*enumerate(slots)], "source_no long, slots long")
    drawn = mixing.drawn_slots(spark, targets, shard_blocks=64).collect()
    ordinals = Counter((r.source_no, r.ordinal) for r in drawn)
    assert ordinals == Counter((i, o) for i, n in enumerate(slots) for o in range(n))
    by_shard = Counter(r.shard for r in drawn)
    total = sum(slots)
    assert by_shard == Counter({s: min(64, total - 64 * s) for s in range(-(-total // 64))})


def test_levels_in_steps_are_those_of_one_sum(spark, monkeypatch):
    bits = [random.Random(i).getrandbits(13) for i in range(900)]
    fine = spark.createDataFrame([(b, b % 7) for b in bits], "prefix long, bytes long")
    fine = fine.groupBy("prefix").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows"))
    for top, levels in ((0, 3), (0, 5), (4, 3), (0, 20), (13, 5)):
        monkeypatch.setattr(sharding, "LEVELS", levels)
        got = sharding._levels(fine, top, 13).select("depth", "prefix", "bytes", "rows")
        want = Counter()
        for b in bits:
            for depth in range(top, 14):
                want[depth, b >> (13 - depth), "bytes"] += b % 7
                want[depth, b >> (13 - depth), "rows"] += 1
        told = got.collect()
        for r in told:
            assert want[r.depth, r.prefix, "bytes"] == r.bytes
            assert want[r.depth, r.prefix, "rows"] == r.rows
        assert len(told) == len({(d, p) for d, p, _ in want})
