"""Customer-retention analytics over sales tables, written as Spark DataFrame plans."""

from holdfast.spec import MarketSpec, RiskLabels, RiskRules, Rule, Windows

__all__ = ["MarketSpec", "RiskLabels", "RiskRules", "Rule", "Windows"]
