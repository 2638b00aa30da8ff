"""Ranks over a whole table and top rows of large groups, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.hashing import digest_number, key_digest
from holdfast.session import store

_ROW_BITS = 33  # low bits of monotonically_increasing_id(): the row's place in its partition


def _running_before(count: Column, order: str) -> Column:
    """Sum of the counts before this row; used on tables with one row per bucket only."""
    window = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(count).over(window), F.lit(0))


def _hashed(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """Adds ``_digest`` and ``_bucket``, its leading 16 bits."""
    return df.withColumn("_digest", key_digest(keys, seed)).withColumn(
        "_bucket", digest_number(F.col("_digest"), 4)
    )


def order_by_hash(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """The rows dealt out by their key hash and sorted by it, then key, in each partition, so
    that reruns find every row in the same place."""
    dealt = _hashed(df, keys, seed).repartition("_bucket")
    return dealt.sortWithinPartitions("_bucket", "_digest", *keys).drop("_digest", "_bucket")


def rank_by_hash(
    df: DataFrame, keys: Sequence[str], seed: int, name: str = "rank", first: int | None = None
) -> DataFrame:
    """Number rows 1..n in the order of their key hash, then key.

    The leading 16 bits of the hash put rows in at most 65,536 even buckets.  Bucket counts,
    hence the numbers before each bucket, are a table of that fixed size, so it is broadcast,
    and rows are numbered bucket by bucket in parallel.  With ``first`` only ranks up to that
    count are wanted, and later buckets are dropped before the exchange.
    """
    df = _hashed(df, keys, seed)
    starts = (
        df.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", _running_before(F.col("_n"), "_bucket").alias("_before"))
    )
    placed = df.join(F.broadcast(starts), "_bucket")
    if first is not None:
        placed = placed.where(F.col("_before") < first)
    order = Window.partitionBy("_bucket").orderBy("_digest", *keys)
    ranked = placed.withColumn(name, F.col("_before") + F.row_number().over(order))
    if first is not None:
        ranked = ranked.where(F.col(name) <= first)
    return ranked.drop("_digest", "_bucket", "_before")


def global_row_number(
    df: DataFrame, order: Sequence[Column], name: str = "row_number"
) -> DataFrame:
    """Number rows 1..n in a total order.

    Spark's range sort places the rows; a row's number is its place in its sorted partition
    plus the rows of the partitions before it.  The sorted rows are stored first, because
    both parts must see the same partition borders.  ``order`` must end in a unique key.
    The broadcast table has one row per sorted partition.
    """
    placed = store(
        df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "sorted"
    ).withColumn("_part", F.shiftright("_place", _ROW_BITS))
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", _running_before(F.col("_n"), "_part").alias("_before"))
    )
    in_part = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_before") + in_part + 1)
        .drop("_place", "_part", "_before")
    )


def top_per_group(
    df: DataFrame,
    group: str,
    order: Sequence[Column],
    count: int,
    spread: Sequence[str],
    name: str = "rank",
    salts: int = 64,
) -> DataFrame:
    """The first ``count`` rows of each group with their rank.

    Each group is first cut into ``salts`` parts by a hash of ``spread`` and reduced to
    ``count`` rows per part, so that the final window holds at most ``salts * count`` rows of
    any group, however large it is.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    part = Window.partitionBy(group, "_salt").orderBy(*order)
    whole = Window.partitionBy(group).orderBy(*order)
    return (
        salted.withColumn(name, F.row_number().over(part))
        .where(F.col(name) <= count)
        .drop("_salt")
        .withColumn(name, F.row_number().over(whole))
        .where(F.col(name) <= count)
    )
