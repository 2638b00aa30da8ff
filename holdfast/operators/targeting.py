"""The client list, who is called, in what order, and last month's notes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.predicates import (
    apply_rules,
    differs_keep_null,
    not_in_keep_null,
    rule_condition,
)
from holdfast.functions.values import round_half_even, sum_parts, to_whole, total_of
from holdfast.operators.activity import newest_period
from holdfast.operators.joins import join_back, keep_members, latest_values, newest_value
from holdfast.operators.ranking import global_row_number
from holdfast.operators.risk import at_risk
from holdfast.sources.feedback import NOTE_COLUMNS
from holdfast.spec import RiskLabels, RiskRules, Rule, Windows


def client_branch_profile(
    sales: DataFrame,
    columns: Sequence[str],
    branch: str = "branch",
    months: int = 12,
    rules: Sequence[Rule] = (),
) -> DataFrame:
    """Newest attributes and 12-month sales per client and branch in one pass over the lines.

    As in ``latest_values`` the lines are reduced to attribute combinations first; their
    sales are summed along the way.
    """
    start = F.add_months(newest_period(apply_rules(sales, rules)), -(months - 1))
    counted = F.col(branch).isNotNull() & (F.col("sale_date") >= start)
    for rule in rules:
        counted = counted & rule_condition(rule)
    parts = sum_parts(F.when(counted, F.col("amount")))
    names = [f"_part{i}" for i in range(len(parts))]
    seen = (
        sales.where(F.col("client_id").isNotNull())
        .groupBy("client_id", F.col(branch).alias("branch"), *columns)
        .agg(
            F.max("sale_date").alias("_date"),
            *[part.alias(name) for part, name in zip(parts, names)],
            F.count_if(counted).alias("_counted"),
        )
    )
    total = total_of(*map(F.sum, names))
    return seen.groupBy("client_id", "branch").agg(
        *[newest_value(c, "_date") for c in columns],
        F.when(F.sum("_counted") > 0, total).alias("sales_12m"),
    )


def client_sellers(sales: DataFrame) -> DataFrame:
    """The newest non-null seller per client."""
    return latest_values(sales, ["client_id"], ["seller"], "sale_date")


def client_list(rollup: DataFrame, profile: DataFrame, *extras: DataFrame) -> DataFrame:
    """One row per client and branch: profile, extra tables, churn, loss and opportunity.

    Every rolled-up client comes from lines, so it has a profile row and an inner join keeps
    it; that also lets the planner split a client with very many branches.  ``extras`` are
    left-joined on the key columns they share with the list.
    """
    df = profile.join(rollup, "client_id")
    for extra in extras:
        keys = [c for c in ("client_id", "branch") if c in extra.columns]
        df = join_back(df, extra, keys)
    loss = (
        F.col("sales_12m") * F.col("client_churn_probability") * F.col("client_margin_est")
    )
    return df.withColumns(
        {
            "client_churn_probability": F.coalesce("client_churn_probability", F.lit(0.0)),
            "expected_loss": F.coalesce(loss, F.lit(0.0)),
            "sales_12m": to_whole(round_half_even(F.col("sales_12m"), 6)),
        }
    )


def top_opportunities(
    risk: DataFrame,
    newest: Column,
    windows: Windows = Windows(),
    rules: RiskRules = RiskRules(),
    labels: RiskLabels = RiskLabels(),
) -> DataFrame:
    """The most valuable opportunities last bought one to four months before the newest month."""
    last = F.col("last_purchase")
    recent_enough = (last >= F.add_months(newest, -windows.opportunity_from)) & (
        last < F.add_months(newest, -windows.opportunity_until)
    )
    return (
        risk.where((F.col("risk_level") == labels.opportunity) & recent_enough)
        .select("client_name", "client_id", "total_value", "margin")
        .distinct()
        .withColumn("adjusted_value", F.col("total_value") * F.col("margin"))
        .orderBy(
            F.col("adjusted_value").desc_nulls_last(),
            F.col("client_id"),
            F.col("total_value").desc(),
            F.col("margin").desc_nulls_last(),
            F.col("client_name"),
        )
        .limit(rules.top_opportunities)
    )


def select_targets(
    clients: DataFrame, top: DataFrame, excluded_sellers: Sequence[str] = ()
) -> DataFrame:
    """Clients at risk or with a top opportunity, less those of excluded sellers.

    Needs the ``has_risk`` mark of the roll-up.  Each such client has a row that can be
    called (an at-risk or an opportunity row), so no further test is needed.  ``top`` has at
    most as many rows as the top list's limit and is broadcast.
    """
    chosen = top.select("client_id").distinct().withColumn("_top", F.lit(True))
    df = clients.join(F.broadcast(chosen), "client_id", "left")
    df = df.where(F.col("has_risk") | F.col("_top").isNotNull()).drop("_top")
    if excluded_sellers:
        df = df.where(not_in_keep_null(F.col("seller"), excluded_sellers))
    return df


def target_detail(risk: DataFrame, targets: DataFrame) -> DataFrame:
    """All product rows of the target clients."""
    return keep_members(risk, targets, "client_id")


def list_order() -> list[Column]:
    return [
        F.col("expected_loss").desc_nulls_last(),
        F.col("client_churn_probability").desc_nulls_last(),
        F.col("potential_win").desc_nulls_last(),
        F.col("client_id").asc_nulls_last(),
        F.col("branch").asc_nulls_last(),
    ]


def rank_clients(targets: DataFrame, name: str = "call_rank") -> DataFrame:
    return global_row_number(targets, list_order(), name)


def carry_over(
    targets: DataFrame, last_list: DataFrame, labels: RiskLabels = RiskLabels()
) -> DataFrame:
    """Last month's notes on every row of a client.

    The old row with the highest ``row_no`` counts, of those with a status: an empty one
    is a row that nobody edited.  Its nulls are carried as well, so a
    match is told from the whole old row, not from its columns.  Clients without one get
    blanks.
    """
    usable = last_list.where(
        (F.col("Estado") != "")
        & differs_keep_null(F.col("motivo_contacto_fallido"), labels.not_at_risk_reason)
    )
    old = usable.groupBy("client_id").agg(
        F.max_by(F.struct(*NOTE_COLUMNS), "row_no").alias("_old")
    )
    matched = F.col("_old").isNotNull()
    return (
        join_back(targets, old, ["client_id"])
        .withColumns(
            {c: F.when(matched, F.col("_old")[c]).otherwise(F.lit("")) for c in NOTE_COLUMNS}
        )
        .drop("_old")
    )
