"""Invoice lines to one row per client, product, branch and month, and what follows from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.predicates import apply_rules, in_closed_window
from holdfast.functions.values import exact_sum, months_apart
from holdfast.spec import KEYS, Rule, Windows


def monthly_activity(sales: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    """Totals and a presence mark per client, product, branch and month.

    Rows with a null key are left out.  Lines are summed inside each task before the
    exchange, so a key that holds much of the table still arrives as one row per task.
    """
    keys = [*KEYS, "period"]
    return (
        sales.na.drop(subset=keys)
        .groupBy(*keys)
        .agg(
            *[exact_sum(F.col(source)).alias(name) for name, source in measures.items()],
            (F.count("sale_date") >= 1).cast("int").alias("frequency"),
            exact_sum(F.col("volume")).alias("volume"),
        )
    )


def with_gaps(activity: DataFrame, by_branch: bool = False) -> DataFrame:
    """Months since the row before it, in order of month then branch.

    The row before may belong to another branch: within a client and product only the first
    branch of a month has a gap, further branches of that month have 0, and so does the
    first month.  That makes the gap a property of client, product and month, so it is found
    on one row per month (a window of at most as many rows as there are months) and joined
    back; no window ever holds all branches of a large client.
    """
    if by_branch:
        order = Window.partitionBy(*KEYS).orderBy("period")
        gap = months_apart(F.col("period"), F.lag("period").over(order))
        return activity.withColumn("max_gap", F.coalesce(gap, F.lit(0)))
    month_keys = ["client_id", "product", "period"]
    order = Window.partitionBy("client_id", "product").orderBy("period")
    gap = months_apart(F.col("period"), F.lag("period").over(order))
    months = (
        activity.groupBy(*month_keys)
        .agg(F.min("branch").alias("_first_branch"))
        .withColumn("_gap", F.coalesce(gap, F.lit(0)))
    )
    first = F.col("branch") == F.col("_first_branch")
    return (
        activity.join(months, month_keys)
        .withColumn("max_gap", F.when(first, F.col("_gap")).otherwise(0))
        .drop("_first_branch", "_gap")
    )


def newest_period(df: DataFrame) -> Column:
    """The latest month in the data as a literal.

    Runs a one-value job: as a constant the month folds into every window test, where a
    sub-query would repeat the whole input plan at each use.
    """
    return F.lit(df.agg(F.max("period")).first()[0]).cast("date")


def sales_total(
    sales: DataFrame,
    months: int = 12,
    branch: str = "branch",
    date: str = "sale_date",
    rules: Sequence[Rule] = (),
) -> DataFrame:
    """Sales per client and branch over the ``months`` months up to the data's newest month."""
    sales = apply_rules(sales, rules)
    start = F.add_months(newest_period(sales), -(months - 1))
    return (
        sales.na.drop(subset=["client_id", branch])
        .where(F.col(date) >= start)
        .groupBy("client_id", F.col(branch).alias("branch"))
        .agg(exact_sum(F.col("amount")).alias("sales_12m"))
    )


_PICK = {"max": F.max, "min": F.min}


def reference_period(
    activity: DataFrame, end: Column, shift: int, span: int, pick: str, keys: Sequence[str] = KEYS
) -> DataFrame:
    """The last (or first) active month per key inside a window that ends ``shift`` months
    before ``end``."""
    window_end = F.add_months(end, -shift)
    return (
        activity.where(in_closed_window(F.col("period"), window_end, span))
        .groupBy(*keys)
        .agg(_PICK[pick]("period").alias("ref_period"))
    )


def older_reference(end: Column, windows: Windows) -> Column:
    """Aggregate: last active month of the older window, null when there is none."""
    window_end = F.add_months(end, -windows.older_end)
    inside = in_closed_window(F.col("period"), window_end, windows.older_span)
    return F.max(F.when(inside, F.col("period")))


def recent_reference(end: Column, windows: Windows) -> Column:
    """Aggregate: first active month of the recent window."""
    inside = in_closed_window(F.col("period"), end, windows.recent_span)
    return F.min(F.when(inside, F.col("period")))


def past_reference(activity: DataFrame, end: Column, windows: Windows = Windows()) -> DataFrame:
    """The month to measure purchase gaps from; the older window wins.

    Both windows are read in one pass.  An empty older window needs no special case.
    """
    return (
        activity.groupBy(*KEYS)
        .agg(
            older_reference(end, windows).alias("_older"),
            recent_reference(end, windows).alias("_recent"),
        )
        .select(
            *KEYS,
            F.coalesce("_older", "_recent").alias("ref_period"),
            F.when(F.col("_older").isNull(), "recent").otherwise("older").alias("ref_kind"),
        )
    )
