"""Result tables, reporting views and exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.predicates import apply_rules, in_previous_month
from holdfast.functions.values import round_half_even
from holdfast.operators.joins import join_back
from holdfast.sources.feedback import Feedback, split_feedback
from holdfast.spec import Rule

PARTITIONS = ("country", "period")


def write_result(
    df: DataFrame, path: str, mode: str = "replace", partitions: Sequence[str] = PARTITIONS
) -> None:
    """Write rows into their country and month.

    ``replace`` overwrites just the partitions present in ``df``, so a rerun leaves the same
    table (a rerun without any row for a month leaves that month as it was); ``append`` adds to them.  The rebalance hint gives each folder files of even size
    and splits a large one over several tasks.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"mode {mode!r}")
    writer = df.hint("rebalance", *partitions).write.partitionBy(*partitions)
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def write_jdbc(df: DataFrame, table: str, options: Mapping[str, str], mode: str = "append") -> None:
    """Append to or replace a database table; connection options come from the caller."""
    save_mode = {"append": "append", "replace": "overwrite"}[mode]
    df.write.format("jdbc").options(**options).option("dbtable", table).mode(save_mode).save()


def risk_view(risk: DataFrame, *extras: DataFrame) -> DataFrame:
    """Risk rows with attributes, sales and flags joined on the key columns they share."""
    df = risk
    for extra in extras:
        keys = [c for c in ("client_id", "product", "branch") if c in extra.columns]
        df = join_back(df, extra, keys)
    return df.withColumns(
        {
            "analysis_period": F.col("analysis_period").cast("date"),
            "monetary_value": round_half_even(F.col("monetary_value"), 2),
        }
    )


def history_view(
    sales: DataFrame, as_of, date: str = "sale_date", rules: Sequence[Rule] = ()
) -> DataFrame:
    """Lines of the month before ``as_of``."""
    return apply_rules(sales, rules).where(in_previous_month(F.col(date), as_of))


def load_feedback(feedback: Feedback, path: str) -> DataFrame:
    """Replace each present country's last list by its edited one; returns rejected rows.

    The files held back, with their reasons, take the place of the last load's in the table
    beside the lists, ``path`` and ``_quarantine``.  Their countries keep the list they have.
    """
    good, bad = split_feedback(feedback.rows)
    write_result(good, path, "replace", ("country",))
    feedback.quarantine.coalesce(1).write.mode("overwrite").parquet(f"{path}_quarantine")
    return bad


def export_tables(
    tables: Mapping[str, DataFrame], root: str, file_format: str = "csv"
) -> None:
    """One folder per table and country, all countries in one job per table."""
    for name, df in tables.items():
        (
            df.hint("rebalance", "country")
            .write.mode("overwrite")
            .option("header", "true")
            .partitionBy("country")
            .format(file_format)
            .save(f"{root}/{name}")
        )
