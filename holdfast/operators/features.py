"""Recency, frequency, spend and gap features, churn labels, and the model's input table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.predicates import in_closed_window, in_half_open_window
from holdfast.functions.values import exact_sum, months_apart, ratio, round_half_even
from holdfast.operators.activity import older_reference, recent_reference, with_gaps
from holdfast.operators.joins import join_back
from holdfast.spec import KEYS, Windows

DAYS_PER_MONTH = 30.4375


def _measures(activity: DataFrame) -> list[str]:
    known = {*KEYS, "period", "frequency", "max_gap"}
    return [c for c in activity.columns if c not in known]


def _aggregates(end: Column, windows: Windows, means: Sequence[str]) -> dict[str, Column]:
    inside = in_half_open_window(F.col("period"), end, windows.features)

    def kept(c: str) -> Column:
        return F.when(inside, F.col(c))

    return {
        **{c: ratio(exact_sum(kept(c)), F.count(kept("period"))) for c in means},
        "frequency": F.sum(kept("frequency")),
        "last_purchase": F.max(kept("period")),
        "max_gap": F.max(kept("max_gap")),
        "older": older_reference(end, windows),
        "recent": recent_reference(end, windows),
    }


def _row(prefix: str, tag: str, end: Column, first: Column, means: Sequence[str]) -> Column:
    """One feature row as a struct, from aggregates named ``prefix + name``."""
    c = {n: F.col(prefix + n) for n in [*means, "frequency", "last_purchase", "max_gap"]}
    older, recent = F.col(prefix + "older"), F.col(prefix + "recent")
    reference = F.coalesce(older, recent)
    days = F.abs(F.datediff(c["last_purchase"], first))
    recency = round_half_even(days / F.lit(DAYS_PER_MONTH)).cast("long") + 1
    span = months_apart(c["last_purchase"], reference) + 1
    purchases = c["frequency"] + F.when(older.isNull(), 0).otherwise(1)
    fields = {
        "data_type": F.lit(tag),
        **{n: F.coalesce(c[n], F.lit(0.0)) for n in means},
        "frequency": F.coalesce(c["frequency"], F.lit(0)).cast("long"),
        "last_purchase": c["last_purchase"],
        "max_gap": F.coalesce(c["max_gap"], F.lit(0)).cast("long"),
        # Months from the start of the window: a larger number is a more recent purchase.
        "recency": recency,
        "ref_period": reference,
        "ref_kind": F.when(older.isNull(), "recent").otherwise("older"),
        "mean_gap": F.coalesce(ratio(span, purchases), F.lit(0.0)),
        "analysis_period": end,
    }
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def features_for_cuts(
    activity: DataFrame,
    cuts: Mapping[str, Column],
    windows: Windows = Windows(),
    gap_by_branch: bool = False,
) -> DataFrame:
    """One row per cut and client-product-branch that was active in the cut's window.

    ``cuts`` maps a tag to the last month of its window.  References to older purchases need
    the same grouping, so all cuts share one aggregation and no join.  Gaps are taken over the
    whole history.  ``activity`` is read twice: a one-row job first finds the first month
    present in each window.
    """
    means, period = _measures(activity), F.col("period")
    firsts = activity.agg(
        *[
            F.min(F.when(in_half_open_window(period, end, windows.features), period))
            for end in cuts.values()
        ]
    ).first()
    aggregates, rows = [], []
    for i, (tag, end) in enumerate(cuts.items()):
        first = F.lit(firsts[i]).cast("date")
        prefix = f"_c{i}_"
        aggregates += [
            column.alias(prefix + name)
            for name, column in _aggregates(end, windows, means).items()
        ]
        rows.append(_row(prefix, tag, end, first, means))
    used = reduce(
        lambda a, b: a | b,
        [
            in_closed_window(period, end, max(windows.features, windows.older_end + windows.older_span))
            for end in cuts.values()
        ],
    )
    return (
        with_gaps(activity, gap_by_branch)
        .where(used)
        .groupBy(*KEYS)
        .agg(*aggregates)
        .select(*KEYS, F.inline(F.array(*rows)))
        .where(F.col("last_purchase").isNotNull())
    )


def build_features(
    activity: DataFrame, end: Column, windows: Windows = Windows()
) -> DataFrame:
    """Features at one cut."""
    return features_for_cuts(activity, {"": end}, windows).drop("data_type")


def label_window(
    activity: DataFrame, end: Column, months: int = 3, by_branch: bool = False
) -> DataFrame:
    """Spend in the look-ahead months; having any row there means the client stayed."""
    keys = list(KEYS) if by_branch else ["client_id", "product"]
    spend = F.col("monetary_value")
    return (
        activity.where(in_half_open_window(F.col("period"), end, months))
        .groupBy(*keys)
        .agg(
            exact_sum(spend).alias("future_spend_total"),
            ratio(exact_sum(spend), F.count(spend)).alias("future_spend_avg"),
        )
        .withColumn("target", F.lit(0))
    )


def attach_label(features: DataFrame, labels: DataFrame, by_branch: bool = False) -> DataFrame:
    """A key without a label row has churned."""
    keys = list(KEYS) if by_branch else ["client_id", "product"]
    return join_back(features, labels.select(*keys, "target"), keys).withColumn(
        "target", F.coalesce("target", F.lit(1))
    )


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """A 0/1 column per listed value; null gives 0 in all of them.

    A projection: nothing is grouped or moved.  For columns with very many values use the
    vector encoder of the model instead.
    """
    return df.withColumns(
        {
            f"{column}_{value}": F.coalesce((F.col(column) == value).cast("int"), F.lit(0))
            for column, values in categories.items()
            for value in values
        }
    )
