"""Comparisons inside groups of any size, and connected components of the links found."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.batches import column
from holdfast.operators.joins import join_back
from holdfast.session import store

BLOCK = 4096  # members of one group that one comparison holds, on average


def blocks_of(members: DataFrame, key: str, member: str, size: int = BLOCK) -> DataFrame:
    """``members`` with ``low`` and ``high``: groups of more than ``size`` rows are cut into
    chunks by the member, and each row goes to every pair of chunks that includes its own;
    ``own`` is its chunk.  Rows of smaller groups get one block.

    Any two members of a group meet in a block, in exactly one if their chunks differ.
    """
    counts = members.groupBy(column(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    large = store(
        counts.where(F.col("_n") > size).select(
            "_key", F.ceil(F.col("_n") / size).cast("int").alias("_chunks")
        ),
        "large-groups",
    )
    joined = members.join(large, column(key) == F.col("_key"), "left").drop("_key")
    chunks = F.coalesce("_chunks", F.lit(1))
    spread = joined.withColumn("own", F.pmod(F.xxhash64(column(member)), chunks).cast("int"))
    spread = spread.withColumn("_other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return spread.withColumns(
        {"low": F.least("own", "_other"), "high": F.greatest("own", "_other")}
    ).drop("_other", "_chunks")


def roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component, for links between 0..count-1."""
    label = np.arange(count)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        np.minimum.at(label, before, label)  # hook what the old label stood for
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further
        if (label[left] == label[right]).all():
            break
    return label


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for all nodes of the links.

    ``links`` has two columns of whole numbers; null ends and loops are left out.  Rounds of
    two steps shrink every component to a star around its smallest node: each node first
    hands its smallest neighbour to the larger ones, then to the smaller ones.  Each step
    aggregates before it joins, so a node with many links is reduced in its tasks, and the
    links of such a node are split by the join.  The number of rounds grows with the
    logarithm of the longest path.  Each round's links are a stored table.
    """
    a, b = (F.col(f"`{c}`").cast("long") for c in links.columns[:2])
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = store(pairs.where("u > v").distinct(), name)
    before = None
    while True:
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            break
        before = state
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        larger = (
            join_back(both.where("v > u"), least, ["u"], "inner")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        larger = store(larger, name)
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = (
            join_back(larger, least, ["u"], "inner")
            .where("v > m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        current = store(
            smaller.union(least.select("u", F.col("m").alias("v"))).distinct(), name
        )
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.union(centres)
