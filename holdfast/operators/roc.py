"""Ranks with ties and the exact area under the curve, over scores in any number."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.operators.joins import join_back
from holdfast.session import store

_ROW_BITS = 33  # low bits of monotonically_increasing_id(): the row's place in its partition
_WIDE = "decimal(38,0)"


def score_groups(df: DataFrame, score: str, target: str = "target") -> DataFrame:
    """One row per distinct ``score`` with its ``positives`` and ``negatives``, and how many of
    either lie below it (``positives_below``, ``negatives_below``).

    Rows are counted by score inside their tasks, so a score that holds much of the table is
    one row per task.  The distinct scores are sorted by range; sums inside a sorted part and
    the sums of the parts before it give the numbers below, and no task holds more than its
    part.  Null scores, NaN and null targets are left out.
    """
    value = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    counts = (
        df.select(value.alias("score"), F.col(target).alias("target"))
        .where(F.col("score").isNotNull() & F.col("target").isNotNull())
        .groupBy("score")
        .agg(
            F.count_if(F.col("target") == 1).alias("positives"),
            F.count_if(F.col("target") == 0).alias("negatives"),
        )
    )
    placed = store(
        counts.orderBy("score").withColumn("_place", F.monotonically_increasing_id()), "scores"
    ).withColumn("_part", F.shiftright("_place", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_part").orderBy("_place")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    both = ("positives", "negatives")
    # One row per sorted part, whatever the number of scores.
    starts = placed.groupBy("_part").agg(*[F.sum(c).alias(f"_{c}") for c in both])
    starts = starts.select(
        "_part", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in both]
    )
    below = {
        f"{c}_below": F.col(f"_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in both
    }
    found = placed.join(F.broadcast(starts), "_part").withColumns(below)
    return found.select("score", *both, *below)


def mid_ranks(df: DataFrame, score: str, name: str = "mid_rank") -> DataFrame:
    """Adds each row's rank by ``score``, from 1 upwards; equal scores share the mean of the
    ranks they take.  Rows without a score have none.

    A score that many rows share is split by the join back to the rows.
    """
    value = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    rows = df.withColumn("_score", value)
    groups = score_groups(rows.withColumn("_any", F.lit(1)), "_score", "_any")
    rank = F.col("positives_below") + (F.col("positives") + 1) / 2
    return join_back(rows, groups.select(F.col("score").alias("_score"), rank.alias(name)), ["_score"]).drop(
        "_score"
    )


def roc_auc(df: DataFrame, score: str, target: str = "target") -> DataFrame:
    """One row: ``positives``, ``negatives`` and ``auc``, the share of pairs of a positive and
    a negative in which the positive scores higher, equal scores counting a half.

    All of it is counted in whole numbers; ``auc`` is null if one class is missing.
    """
    won = F.col("positives").cast("decimal(19,0)") * (
        2 * F.col("negatives_below") + F.col("negatives")
    ).cast("decimal(19,0)")
    sums = score_groups(df, score, target).agg(
        F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("negatives"), F.lit(0)).alias("negatives"),
        F.sum(won.cast(_WIDE)).cast("double").alias("_won"),
    )
    pairs = 2.0 * F.col("positives") * F.col("negatives")
    return sums.select("positives", "negatives", F.try_divide("_won", pairs).alias("auc"))
