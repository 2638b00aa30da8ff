"""SimHash near-duplicates found at anchor points of a covering code."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.batches import annotate, by_runs, column, expand, free_name
from holdfast.llm.groups import blocks_of, components, roots
from holdfast.llm.rows import documents
from holdfast.llm.text import encoded
from holdfast.session import store

SHINGLE = 3
SEED = 42
DISTANCE = 3
_ALL = (1 << 64) - 1
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits: each is 1 if set in over half of the hashes of the word shingles."""
    import xxhash

    words = encoded(text).translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(1, len(words) - shingle + 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes).tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        [digest(joined[a:b], seed) for a, b in zip(starts, stops)], np.uint64, count
    )
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little")
    set_in = bits.reshape(count, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > count, bitorder="little").view("<i8")[0])


FIELDS = T.StructType([T.StructField("value", T.LongType(), False)])


def fingerprints(
    docs: DataFrame, *, text: str = "text", carry: Sequence[str] = ("doc_id",), result: str
) -> DataFrame:
    """``carry`` and a struct with the fingerprint as a signed number."""

    def start():
        return lambda texts: [(fingerprint(t or ""),) for t in texts]

    return annotate(docs, [text], carry, result, FIELDS, start)


# The Hamming code of length 31: a perfect covering code of radius 1.  A word's syndrome is
# the exclusive or of the positions (1..31) of its set bits; words of syndrome 0 are anchors.
_LENGTH = 31
_CHECKS = [
    sum(1 << (p - 1) for p in range(1, _LENGTH + 1) if p >> k & 1) for k in range(5)
]


def _corrections() -> np.ndarray:
    """By syndrome, the differences that lead to anchors within distance 2: none for an
    anchor itself; else one position, and the 15 pairs of positions with that syndrome."""
    table = np.zeros((32, 16), np.int64)
    for s in range(1, 32):
        pairs = [(a, a ^ s) for a in range(1, 32) if a ^ s > a]
        masks = [1 << (s - 1)] + [1 << (a - 1) | 1 << (b - 1) for a, b in pairs]
        table[s] = masks
    return table


CORRECTIONS = _corrections()


def anchors(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index into ``values`` and anchor, for every anchor a fingerprint is sent to.

    Two fingerprints at most 3 bits apart differ in at most 1 bit in one of their halves.
    Of each half 31 bits are covered by the code, radius 1; so the anchor nearest to one lies
    within 1 + 1 of the other.  Sent to all anchors within that distance, at most 16 in each
    half, both meet there.
    """
    where, keys = [], []
    for half in (0, 1):
        part = (values >> np.int64(32 * half)) & np.int64((1 << _LENGTH) - 1)
        syndrome = np.zeros(len(values), np.int64)
        for k, check in enumerate(_CHECKS):
            syndrome |= (np.bitwise_count(part & np.int64(check)).astype(np.int64) & 1) << k
        sent = part[:, None] ^ CORRECTIONS[syndrome]
        wanted = np.ones(sent.shape, bool)
        wanted[syndrome == 0, 1:] = False
        index, _ = np.nonzero(wanted)
        where.append(index)
        keys.append(sent[wanted] | np.int64(half << 32))
    return np.concatenate(where), np.concatenate(keys)


MEMBERS = T.StructType(
    [T.StructField("anchor", T.LongType(), False), T.StructField("value", T.LongType(), False)]
)
LINKS = T.StructType(
    [T.StructField("a", T.LongType(), False), T.StructField("b", T.LongType(), False)]
)


def linked_values(values: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links between distinct fingerprints (column ``value``) at most ``distance`` bits apart,
    as few as keep them connected: per anchor each fingerprint is linked to the smallest one
    it reaches there, so no group yields its pairs."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"the anchors cover distances up to {DISTANCE}")

    def start_members():
        def compute(batch: pa.RecordBatch):
            found = np.asarray(batch.column(0))
            where, keys = anchors(found)
            return [keys, found[where]]

        return compute

    members = expand(values.select("value"), MEMBERS, start_members)

    def start_links():
        def compute(group: pa.Table):
            if group.num_rows == 2:
                a, b = sorted(group.column("value").to_pylist())
                return [[b], [a]] if ((a ^ b) & _ALL).bit_count() <= distance else None
            found = np.sort(np.asarray(group.column("value")))
            bits = found.view(np.uint64)  # of signed numbers only absolute values are counted
            left, right = [], []
            for i in range(0, len(found), 512):
                apart = np.bitwise_count(bits[i : i + 512, None] ^ bits[None, i:])
                x, y = np.nonzero(apart <= distance)
                forward = y > x
                left.append(x[forward] + i)
                right.append(y[forward] + i)
            left, right = np.concatenate(left), np.concatenate(right)
            root = roots(len(found), left, right)
            bound = np.flatnonzero(root != np.arange(len(found)))
            return [found[bound], found[root[bound]]]

        return compute

    dealt = blocks_of(members, "anchor", "value").drop("own")
    return by_runs(dealt, ["anchor", "low", "high"], LINKS, start_links).distinct()


def _classified(
    docs: DataFrame, text: str, doc_id: str, distance: int
) -> tuple[DataFrame, DataFrame]:
    """Documents with fingerprints; fingerprints with ``component`` and ``component_id``."""
    found = fingerprints(docs, text=text, carry=[doc_id], result="print")
    found = store(
        found.select(column(doc_id).alias("doc_id"), F.col("print.value").alias("value")), "prints"
    )
    classes = store(found.groupBy("value").agg(F.min("doc_id").alias("first_id")), "classes")
    return found, _components_of(classes, linked_values(classes, distance))


def _components_of(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (``value`` and ``first_id``) with ``component`` and ``component_id``."""
    linked = components(links, "fingerprints")
    named = classes.join(linked, classes["value"] == linked["node"], "left").select(
        "value", "first_id", F.coalesce("component", "value").alias("component")
    )
    named = store(named, "named")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_value = named.join(smallest.repartition("component", "component_id"), "component")
    return store(by_value.select("value", "component", "component_id"), "component-ids")


def near_duplicates(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", distance: int = DISTANCE
) -> DataFrame:
    """``doc_id``, ``value`` (the fingerprint) and ``component_id``, the smallest ``doc_id``
    reachable over links between fingerprints at most ``distance`` bits apart.

    Equal fingerprints are one class, counted before anything is compared, so exact copies
    cost one row.  Null and empty texts and texts without words have fingerprint 0 and link
    like any other.  A null ``doc_id`` never names a component; one that has no other id
    gets null.  Repeated rows repeat.  An empty table gives an empty one.
    """
    found, by_value = _classified(docs, text, doc_id, distance)
    return found.join(by_value, "value").select("doc_id", "value", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest id, with all its columns.

    Rows that repeat that id are one document, and one of them stays; of a component whose
    documents have no id at all, one stays too.
    """
    found, by_value = _classified(docs, "text", "doc_id", DISTANCE)
    return _one_of_each(docs, found, by_value)


def _one_of_each(docs: DataFrame, found: DataFrame, by_value: DataFrame) -> DataFrame:
    ids = found.join(by_value, "value").groupBy("doc_id")
    ids = ids.agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("component_id"))
    # The ids that go, or need a second look, are fewer than those that stay.
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = store(ids.where((~stays | (F.col("n") > 1)) & F.col("doc_id").isNotNull()), "other-ids")
    name, mark = free_name(docs, "_print"), free_name(docs, "_mark")
    same = column("doc_id") == F.col("_id")
    others = ids.select(F.col("doc_id").alias("_id"))
    once = docs.where(column("doc_id").isNotNull()).join(others, same, "left_anti")
    again = docs.join(ids.where(stays).select(F.col("doc_id").alias("_id")), same, "left_semi")
    again = again.withColumn(mark, column("doc_id")).dropDuplicates([mark])
    nameless = fingerprints(
        docs.where(column("doc_id").isNull()), carry=docs.columns, result=name
    ).withColumn(mark, column(name)["value"])
    alone = by_value.where("component_id IS NULL").select(
        F.col("value").alias("_value"), F.col("component").alias("_component")
    )
    nameless = nameless.join(alone, column(mark) == F.col("_value")).dropDuplicates(["_component"])
    columns = [column(c) for c in docs.columns]
    return once.select(*columns).unionByName(again.select(*columns)).unionByName(
        nameless.select(*columns)
    )


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("value"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
