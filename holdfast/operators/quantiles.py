"""Exact, linearly interpolated quantiles of whole columns.

Spark's own ``percentile`` gathers every distinct value in one task.  Here a histogram finds
the narrow value range that holds each wanted rank, and only that range is looked at row by
row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.operators.sketches import sketch_quantiles

# Buckets per factor e of the value; amounts below 1e12 fill at most about 230,000 buckets.
_PER_FACTOR = 4096


def _bucket(value: Column) -> Column:
    """A whole number that never falls while the value rises."""
    return (F.signum(value) * F.floor(F.log1p(F.abs(value)) * _PER_FACTOR)).cast("long")


def _running_before(keys: Sequence[str], order: str) -> Column:
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(window), F.lit(0))


_OF = ["_group", "_column"]
_HIT = "_group string, _column string, _bucket long, _prob double, _side int, _rank long"


def order_statistics(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: str | None = None
) -> dict[tuple[str, str, float], tuple[float, float, float]]:
    """Per group, column and probability: the two neighbouring values and the fraction between.

    Like ``approxQuantile`` this runs jobs and returns plain numbers; what reaches the driver
    is two rows per group, column and probability.  Nulls are ignored.  ``df`` is read twice,
    so store it first if it is costly.
    """
    group = F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("")
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_value"))
            for c in columns
        ]
    )
    values = (
        df.select(group.alias("_group"), F.inline(cells))
        .where(F.col("_value").isNotNull())
        .withColumn("_bucket", _bucket(F.col("_value")))
    )
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("_prob")
    place = F.col("_prob") * (F.col("_total") - 1)
    sides = F.posexplode(F.array(F.floor(place), F.ceil(place))).alias("_side", "_rank")
    holds = (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n"))
    left = (F.col("_rank") - F.col("_before")).alias("_rank")
    # Bucket counts, few whatever the table's size, then the buckets that hold a wanted rank.
    hits = (
        values.groupBy(*_OF, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumns(
            {
                "_before": _running_before(_OF, "_bucket"),
                "_total": F.sum("_n").over(Window.partitionBy(*_OF)),
            }
        )
        .select("*", wanted)
        .select("*", (place - F.floor(place)).alias("fraction"), sides)
        .where(holds)
        .select(*_OF, "_bucket", "_prob", "_side", left, "fraction")
        .collect()
    )
    if not hits:
        return {}
    # Only the rows of those buckets are looked at one by one.
    here = [*_OF, "_bucket"]
    ranks = df.sparkSession.createDataFrame([tuple(h)[:-1] for h in hits], _HIT)
    inside = reduce(
        lambda a, b: a | b,
        [
            (F.col("_group") == g) & (F.col("_column") == c) & (F.col("_bucket") == k)
            for g, c, k in {(h["_group"], h["_column"], h["_bucket"]) for h in hits}
        ],
    )
    found = (
        values.where(inside)
        .groupBy(*here, "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", _running_before(here, "_value"))
        .join(F.broadcast(ranks), here)
        .where(holds)
        .select(*_OF, "_prob", "_side", "_value")
        .collect()
    )
    at = {(r["_group"], r["_column"], r["_prob"], r["_side"]): r["_value"] for r in found}
    fractions = {(h["_group"], h["_column"], h["_prob"]): h["fraction"] for h in hits}
    return {key: (at[(*key, 0)], at[(*key, 1)], f) for key, f in fractions.items()}


def interpolate(low, high, fraction):
    return low + (high - low) * fraction


Statistics = dict[tuple[str, str, float], tuple[float, float, float]]


def sketched_statistics(sketches: DataFrame, probs: Sequence[float], by: str | None = None) -> Statistics:
    """As ``order_statistics``, from merged sketches (``operators.sketches``): approximate, and
    without a look at any row."""
    found = sketch_quantiles(sketches, probs).collect()
    return {
        ((r[by] or "") if by else "", r["column"], r["prob"]): (r["value"], r["value"], 0.0)
        for r in found
    }


def cap_floor(
    df: DataFrame,
    columns: Sequence[str],
    cap: float,
    floor: float,
    by: str | None = None,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """Cap columns at their upper quantile, then raise them to the lower quantile of the
    capped column; nulls stay null.

    Capping never changes the order of values, so the capped column's lower quantile lies
    between the same two neighbours, each capped.  One search thus serves both limits, which
    are then constants in a projection.  With ``sketches`` of the groups ``by`` (text) the
    limits are those sketches' quantiles.
    """
    if sketches is None:
        found = order_statistics(df, columns, [cap, floor], by)
    else:
        found = sketched_statistics(sketches, [cap, floor], by)
    changes = {}
    for column in columns:
        value = result = F.col(column)
        for group in sorted({g for g, c, _ in found if c == column}):
            top = interpolate(*found[group, column, cap])
            low, high, fraction = found[group, column, floor]
            bottom = interpolate(min(low, top), min(high, top), fraction)
            capped = F.when(value > top, top).otherwise(value)
            limited = F.when(capped < bottom, bottom).otherwise(capped)
            if by is None:
                result = limited
            else:
                same = F.coalesce(F.col(by).cast("string"), F.lit("")) == group
                result = F.when(same, limited).otherwise(result)
        changes[column] = result
    return df.withColumns(changes)
