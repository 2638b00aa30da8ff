"""Risk levels and what they mean for a product row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.values import to_whole
from holdfast.spec import RiskLabels, RiskRules


def risk_label(rules: RiskRules = RiskRules(), labels: RiskLabels = RiskLabels()) -> Column:
    """Rare buyers are opportunities; others are graded by probability."""
    p = F.col("churn_probability")
    return (
        F.when(F.col("frequency") <= rules.rare_until, labels.opportunity)
        .when(p >= rules.lost, labels.lost)
        .when(p >= rules.high, labels.high)
        .when(p >= rules.at_risk, labels.at_risk)
        .when(p >= 0, labels.stable)
        .otherwise(labels.unknown)
    )


def classify_risk(
    df: DataFrame, rules: RiskRules = RiskRules(), labels: RiskLabels = RiskLabels()
) -> DataFrame:
    """Adds ``risk_level``.  Opportunities lose their probability first; then a purchase in
    the analysis month relabels the row."""
    graded = df.withColumn("risk_level", risk_label(rules, labels))
    opportunity = F.col("risk_level") == labels.opportunity
    bought_now = F.col("last_purchase") == F.col("analysis_period")
    return graded.withColumns(
        {
            "churn_probability": F.when(~opportunity, F.col("churn_probability")),
            "risk_level": F.when(bought_now, labels.recent).otherwise(F.col("risk_level")),
        }
    )


def with_total_value(df: DataFrame) -> DataFrame:
    return df.withColumn("total_value", F.col("monetary_value") * F.col("frequency"))


def buy_probability(df: DataFrame, labels: RiskLabels = RiskLabels()) -> DataFrame:
    """Percent chance of buying: 0 for opportunities and where no probability is known."""
    chance = F.when(
        F.col("risk_level") != labels.opportunity, F.lit(1.0) - F.col("churn_probability")
    )
    return df.withColumn("buy_probability", to_whole(F.coalesce(chance, F.lit(0.0)) * 100))


def at_risk(rules: RiskRules = RiskRules(), labels: RiskLabels = RiskLabels()) -> Column:
    """Likely to leave, not an opportunity and without a purchase in the analysis month."""
    return (F.col("churn_probability") >= rules.at_risk) & ~F.col("risk_level").isin(
        labels.opportunity, labels.recent
    )
