"""Names for rows that have no reliable key of their own, and tables stored between steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.batches import column
from holdfast.session import store


def row_digest(*names: str) -> Column:
    """Hex MD5 of some columns, never null; null differs from every value."""
    parts = []
    for name in names:
        text = column(name).cast("string")
        parts += [F.when(text.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), text)), F.lit("|")]
    return F.md5(F.concat(*parts))


#: Rows of one digest that are numbered in one task.
MOST_EQUAL = 4096


def numbered(df: DataFrame, digest: str, name: str, counts: DataFrame | None = None) -> DataFrame:
    """Number the rows of equal digest from 0.

    Such rows are repeated rows, equal in all that the digest covers, so it does not matter
    which of them gets which number.  A digest with more than ``MOST_EQUAL`` rows is dealt to
    parts of about that many; a row's number is its place in its part plus the rows of the
    parts before.  ``counts`` (``digest``, ``n``) tells the rows of such digests where they
    are known; otherwise ``df`` is read once more, so it should be a stored table.
    """
    if counts is None:
        counts = df.groupBy(digest).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_EQUAL)
    hot = counts.select(
        F.col(digest).alias("_hot"), (F.expr(f"n div {MOST_EQUAL}") + 1).alias("_parts")
    )
    hot = store(hot, "large-digests")
    alone = Window.partitionBy(digest).orderBy(digest)
    if hot.isEmpty():
        return df.withColumn(name, F.row_number().over(alone) - 1)
    few = df.join(hot, F.col(digest) == F.col("_hot"), "left_anti")
    few = few.withColumn(name, F.row_number().over(alone) - 1)
    # Stored, because the parts must be the same where they are counted and where numbered.
    dealt = df.join(hot, F.col(digest) == F.col("_hot")).withColumn(
        "_part", F.pmod(F.monotonically_increasing_id(), F.col("_parts"))
    )
    dealt = store(dealt.drop("_hot", "_parts"), "dealt-rows")
    earlier = Window.partitionBy("_hot").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(F.col(digest).alias("_hot"), F.col("_part").alias("_of")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    starts = starts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    part = Window.partitionBy(digest, "_part").orderBy(digest)
    many = dealt.withColumn(name, F.row_number().over(part) - 1).join(
        starts, (F.col(digest) == F.col("_hot")) & (F.col("_part") == F.col("_of"))
    )
    many = many.withColumn(name, (F.col("_before") + column(name)).cast("int"))
    return few.unionByName(many.drop("_part", "_hot", "_of", "_n", "_before"))


def running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """Add the sums of whole numbers over all rows before each row.

    Rows are sorted by range and stored; a row's sum is that of the rows before it in its
    sorted partition plus the totals of the partitions before, a table with one row per
    partition.  ``order`` must be total.
    """
    names = list(sums)
    sorted_rows = store(
        df.orderBy(*order)
        .withColumns({f"_of_{n}": c for n, c in sums.items()})
        .withColumn("_place", F.monotonically_increasing_id()),
        "sorted",
    ).withColumn("_part", F.shiftright("_place", 33))
    earlier = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = sorted_rows.groupBy(F.col("_part").alias("_at")).agg(
        *[F.sum(f"_of_{n}").alias(f"_total_{n}") for n in names]
    )
    starts = starts.select(
        "_at",
        *[F.coalesce(F.sum(f"_total_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in names],
    )
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    placed = sorted_rows.withColumns(
        {n: F.coalesce(F.sum(f"_of_{n}").over(inside), F.lit(0)) for n in names}
    )
    # One row per sorted partition, whatever the rows.
    joined = placed.join(F.broadcast(starts), F.col("_part") == F.col("_at"))
    return joined.select(
        *map(column, df.columns), *[(F.col(n) + F.col(f"_before_{n}")).alias(n) for n in names]
    )


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
