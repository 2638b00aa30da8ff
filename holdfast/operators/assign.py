"""Who calls a client: its own seller, the call centre, or a named agent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.joins import join_back
from holdfast.operators.quantiles import interpolate
from holdfast.operators.ranking import rank_by_hash, top_per_group
from holdfast.spec import RiskLabels

CENTRE = RiskLabels().centre


def seller_load(df: DataFrame, column: str = "seller") -> DataFrame:
    """Clients per seller, largest first."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("clients"))
        .orderBy(F.col("clients").desc(), F.col(column).asc_nulls_last())
    )


def with_seller(df: DataFrame, sellers: DataFrame, default: str) -> DataFrame:
    """The client's seller from a table, or a default text."""
    return df.join(sellers, "client_id", "left").withColumn(
        "seller", F.coalesce("seller", F.lit(default))
    )


def assign_by_limit(df: DataFrame, limit: float, centre: str = CENTRE) -> DataFrame:
    """Clients above a sales limit stay with their seller; the rest go to the call centre."""
    return df.withColumn(
        "assignee", F.when(F.col("sales_12m") > limit, F.col("seller")).otherwise(centre)
    )


def assign_by_list(df: DataFrame, centre_clients: DataFrame, centre: str = CENTRE) -> DataFrame:
    """Listed clients go to the call centre, others to their seller."""
    listed = centre_clients.select("client_id").distinct().withColumn("_listed", F.lit(True))
    return (
        join_back(df, listed, ["client_id"])
        .withColumn("assignee", F.when(F.col("_listed"), centre).otherwise(F.col("seller")))
        .drop("_listed")
    )


def share_bounds(count: int, shares: Mapping[str, float]) -> list[tuple[str, int]]:
    """Last rank of each agent when drawn one after another from the clients left over."""
    taken, left, bounds = 0, 1.0, []
    for agent, share in shares.items():
        part, rest = share / left, count - taken
        taken += rest if abs(part - 1.0) < 0.01 else round(rest * part)
        bounds.append((agent, taken))
        left -= share
    return bounds


def allocate_shares(
    df: DataFrame, shares: Mapping[str, float], seed: int = 10, centre: str = CENTRE
) -> DataFrame:
    """Spread the call centre's clients over agents by share.

    Clients are drawn in hash order and stay whole, so every row keeps an assignee; those
    beyond the sum of the shares stay with the centre.
    """
    clients = df.where(F.col("assignee") == centre).select("client_id").distinct()
    ranked = rank_by_hash(clients, ["client_id"], seed, "_rank")
    agent = F.lit(centre)
    for name, last in reversed(share_bounds(clients.count(), shares)):
        agent = F.when(F.col("_rank") <= last, F.lit(name)).otherwise(agent)
    agents = ranked.select("client_id", agent.alias("_agent"))
    mine = (F.col("assignee") == centre) & F.col("_agent").isNotNull()
    return (
        df.join(agents, "client_id", "left")
        .withColumn("assignee", F.when(mine, F.col("_agent")).otherwise(F.col("assignee")))
        .drop("_agent")
    )


def assign_quota(
    df: DataFrame,
    quantile: float,
    smallest: int,
    largest: int,
    excluded: Sequence[str] = (),
    centre: str = CENTRE,
) -> DataFrame:
    """Portfolio rules per seller.

    Excluded sellers and those with fewer than ``smallest`` clients give all to the centre;
    up to ``largest`` they keep all; above that they keep the clients at or over the sales
    quantile, at most ``largest`` and at least ``smallest``.

    What an oversized seller keeps is always a head of its clients by falling sales, never
    longer than ``largest``.  The first ``largest + 1`` rows therefore decide everything: if
    the quantile lies below them the head is full, otherwise its two neighbours are among
    them.
    """
    per_seller = df.groupBy("seller").agg(
        F.count(F.lit(1)).alias("_rows"), F.count("sales_12m").alias("_known")
    )
    order = [F.col("sales_12m").desc_nulls_last(), F.col("client_id"), F.col("branch")]
    top = top_per_group(
        df.select("seller", "client_id", "branch", "sales_12m").where(F.col("seller").isNotNull()),
        "seller",
        order,
        largest + 1,
        ["client_id", "branch"],
        "_rank",
    )
    place = F.lit(float(quantile)) * (F.col("_known") - 1)
    above, below = F.col("_known") - F.ceil(place), F.col("_known") - F.floor(place)
    oversized = top.join(per_seller.where(F.col("_rows") > largest), "seller")

    def sales_at(rank: Column) -> Column:
        return F.max(F.when(F.col("_rank") == rank, F.col("sales_12m")))

    limits = oversized.groupBy("seller").agg(
        F.max(above).alias("_above"),
        interpolate(sales_at(below), sales_at(above), F.max(place - F.floor(place))).alias("_limit"),
    )
    reached = F.count_if(F.col("sales_12m") >= F.col("_limit"))
    heads = (
        oversized.join(limits, "seller")
        .groupBy("seller")
        .agg(
            F.when(F.max("_above") > largest, F.lit(largest))
            .otherwise(F.least(F.greatest(reached, F.lit(smallest)), F.lit(largest)))
            .alias("_head")
        )
    )
    kept = (
        top.join(heads, "seller")
        .where(F.col("_rank") <= F.col("_head"))
        .select("seller", "client_id", "branch", F.lit(True).alias("_kept"))
    )
    stays = (
        F.when(F.col("seller").isNull() | F.col("seller").isin(*excluded), False)
        .when(F.col("_rows") < smallest, False)
        .when(F.col("_rows") <= largest, True)
        .otherwise(F.coalesce("_kept", F.lit(False)))
    )
    return (
        join_back(df, per_seller.where(F.col("seller").isNotNull()), ["seller"])
        .join(kept, ["seller", "client_id", "branch"], "left")
        .withColumn("assignee", F.when(stays, F.col("seller")).otherwise(centre))
        .drop("_rows", "_known", "_kept")
    )
