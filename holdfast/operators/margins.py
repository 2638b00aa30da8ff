"""Margin tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unpivot_margin(table: DataFrame, product: str) -> DataFrame:
    """A cross table of product by branch to rows; empty cells are dropped."""
    branches = [c for c in table.columns if c != product]
    return (
        table.withColumnRenamed(product, "product")
        .unpivot("product", branches, "branch", "margin")
        .na.drop(subset=["margin"])
    )


def join_margin(df: DataFrame, margins: DataFrame) -> DataFrame:
    """``margins`` should be a stored table: then its size is known from its files, and the
    planner broadcasts it, without an exchange of ``df``, if that is under its threshold."""
    return df.join(margins, ["product", "branch"], "left")
