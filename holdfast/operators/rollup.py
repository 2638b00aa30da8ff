"""Product rows to clients: churn, margin, loss and opportunity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.values import exact_sum, ratio
from holdfast.operators.joins import join_back
from holdfast.operators.risk import at_risk
from holdfast.spec import RiskLabels, RiskRules


def client_names(df: DataFrame) -> DataFrame:
    """One name per client: the least of its non-null names, whatever the row order."""
    names = df.select("client_id", "client_name").distinct()  # hashed; a text minimum sorts
    return names.groupBy("client_id").agg(F.min("client_name").alias("client_name"))


def share_of_client(risk: DataFrame, labels: RiskLabels = RiskLabels()) -> DataFrame:
    """Each row's part of its client's spend, over rows that are not opportunities.

    The client total is aggregated and joined back; a window would hold every row of a large
    client in one task.
    """
    rows = risk.where(F.col("risk_level") != labels.opportunity)
    totals = rows.groupBy("client_id").agg(exact_sum(F.col("total_value")).alias("client_value"))
    return join_back(rows, totals, ["client_id"], "inner").withColumn(
        "share", ratio(F.col("total_value"), F.col("client_value"))
    )


def _churn_columns(counted: Column) -> dict[str, Column]:
    total = F.col("total_value")
    weight = exact_sum(F.when(counted, total))
    return {
        "client_churn_probability": ratio(
            exact_sum(F.when(counted, F.col("churn_probability") * total)), weight
        ),
        "client_margin_est": ratio(exact_sum(F.when(counted, F.col("margin") * total)), weight),
    }


def client_churn(risk: DataFrame, labels: RiskLabels = RiskLabels()) -> DataFrame:
    """Spend-weighted mean probability and margin.  A row without probability adds its spend
    to the weight only."""
    counted = F.col("risk_level") != labels.opportunity
    columns = _churn_columns(counted)
    return (
        risk.where(counted)
        .groupBy("client_id")
        .agg(*[column.alias(name) for name, column in columns.items()])
    )


def client_opportunity(risk: DataFrame, labels: RiskLabels = RiskLabels()) -> DataFrame:
    return (
        risk.where(F.col("risk_level") == labels.opportunity)
        .groupBy("client_id")
        .agg(exact_sum(F.col("total_value") * F.col("margin")).alias("potential_win"))
    )


def client_rollup(
    risk: DataFrame, rules: RiskRules = RiskRules(), labels: RiskLabels = RiskLabels()
) -> DataFrame:
    """Name, churn, margin, opportunity and the at-risk mark per client in one aggregation.

    A client has one name, which therefore is a key here.
    """
    opportunity = F.col("risk_level") == labels.opportunity
    columns = {
        **_churn_columns(~opportunity),
        "potential_win": F.when(
            F.max(opportunity.cast("int")) == 1,
            exact_sum(F.when(opportunity, F.col("total_value") * F.col("margin"))),
        ),
        "has_risk": F.coalesce(F.max(at_risk(rules, labels)), F.lit(False)),
    }
    return risk.groupBy("client_id", "client_name").agg(
        *[c.alias(n) for n, c in columns.items()]
    )


def risk_counts(clients: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Clients, at risk, at risk with an opportunity, with an opportunity."""
    risky = F.col("client_churn_probability") >= threshold
    offered = F.col("potential_win").isNotNull()
    return clients.agg(
        F.count(F.lit(1)).alias("clients"),
        F.count_if(risky).alias("at_risk"),
        F.count_if(risky & offered).alias("at_risk_with_opportunity"),
        F.count_if(offered).alias("with_opportunity"),
    )


def worst_band(risk: DataFrame, keys: list[str], labels: RiskLabels = RiskLabels()) -> DataFrame:
    """2 for any risk level, 1 for an opportunity, 0 otherwise; the greatest per key."""
    severity = (
        F.when(F.col("risk_level").isin(labels.lost, labels.high, labels.at_risk), 2)
        .when(F.col("risk_level") == labels.opportunity, 1)
        .otherwise(0)
    )
    return risk.groupBy(*keys).agg(F.max(severity).alias("severity"))


def band_clients(
    clients: DataFrame, risk: DataFrame, keys: list[str], labels: RiskLabels = RiskLabels()
) -> DataFrame:
    """Adds ``band``: Risk, Opportunity or Out; a client without risk rows is Out."""
    band = (
        F.when(F.col("severity") == 2, "Risk")
        .when(F.col("severity") == 1, "Opportunity")
        .otherwise("Out")
    )
    joined = join_back(clients, worst_band(risk, keys, labels), keys)
    return joined.withColumn("band", band).drop("severity")
