"""Hold-out measures from counts of label and prediction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.values import ratio


def with_prediction(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return df.withColumn("prediction", (F.col("churn_probability") > threshold).cast("int"))


def confusion(df: DataFrame) -> DataFrame:
    """One row of counts: hits and misses of both classes."""
    y, p = F.col("target"), F.col("prediction")
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )


def _or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def classification_report(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, and their averages, a class per row.

    A share of nothing is 0.  The accuracy row repeats the accuracy in every column.
    """
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def measures(hit: Column, false: Column, missed: Column) -> list[Column]:
        precision, recall = _or_zero(hit, hit + false), _or_zero(hit, hit + missed)
        f1 = _or_zero(2 * hit, 2 * hit + false + missed)
        return [precision, recall, f1]

    stayed, churned = measures(tn, fn, fp), measures(tp, fp, fn)
    n0, n1 = (tn + fp).cast("double"), (tp + fn).cast("double")
    total = n0 + n1
    accuracy = _or_zero(tp + tn, total)
    macro = [(a + b) / 2 for a, b in zip(stayed, churned)]
    weighted = [_or_zero(a * n0 + b * n1, total) for a, b in zip(stayed, churned)]

    def row(name: str, values: list[Column], support: Column) -> Column:
        names = ("precision", "recall", "f1_score")
        return F.struct(
            F.lit(name).alias("class"),
            *[v.alias(n) for v, n in zip(values, names)],
            support.alias("support"),
        )

    rows = F.array(
        row("0", stayed, n0),
        row("1", churned, n1),
        row("accuracy", [accuracy] * 3, accuracy),
        row("macro avg", macro, total),
        row("weighted avg", weighted, total),
    )
    return confusion(df).select(F.inline(rows))


def auc_of_labels(df: DataFrame) -> DataFrame:
    """Area under the curve of the hard labels: the mean of both classes' recall."""
    counts = confusion(df)
    tpr = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    tnr = ratio(F.col("tn"), F.col("tn") + F.col("fp"))
    return counts.select(((tpr + tnr) / 2).alias("auc"))


def churn_rate(df: DataFrame, rare_until: int = 3) -> DataFrame:
    """Class shares among frequent buyers, before balancing."""
    target = F.col("target")
    churners = F.count_if(target == 1)
    rows = F.count(F.lit(1))
    return df.where(F.col("frequency") > rare_until).agg(
        rows.alias("rows"),
        churners.alias("churners"),
        ratio(churners, rows).alias("churn_rate"),
        ratio(F.count_if(target == 0), rows).alias("loyal_rate"),
    )


def metrics_table(scored: DataFrame, population: DataFrame, rare_until: int = 3) -> DataFrame:
    """The report with the area and the churn rate as further rows."""

    def single(df: DataFrame, name: str, column: str) -> DataFrame:
        value = F.col(column)
        return df.select(
            F.lit(name).alias("class"),
            *[value.alias(c) for c in ("precision", "recall", "f1_score", "support")],
        )

    return (
        classification_report(scored)
        .unionByName(single(auc_of_labels(scored), "AUC", "auc"))
        .unionByName(single(churn_rate(population, rare_until), "Churn Rate", "churn_rate"))
    )
