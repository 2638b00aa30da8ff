"""Around the monthly run: export of banded lists and the way back of edited ones.

Each step handles all countries in one job; ``country`` is a column, not a loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.commit import read_published
from holdfast.operators.publish import export_tables, load_feedback
from holdfast.operators.rollup import band_clients
from holdfast.sources.feedback import read_feedback
from holdfast.sources.tables import period_slice
from holdfast.spec import RiskLabels

# Fixed value: this country's list is banded by client alone, the others by client and branch.
BY_CLIENT = ("pe",)


def _results(spark: SparkSession, root: str, name: str, period: str) -> DataFrame:
    # Of one commit per market; markets' lists differ in their further columns.
    stored = read_published(spark, root, name)
    if stored is None:
        raise ValueError(f"nothing is published under {root}")
    return period_slice(stored, period)


def banded_lists(
    clients: DataFrame, risk: DataFrame, labels: RiskLabels = RiskLabels()
) -> DataFrame:
    """Every country's clients with the worst band of their product rows."""
    whole = F.col("country").isin(*BY_CLIENT)
    keys = ["country", "_client", "_branch"]
    added = {
        "_client": F.col("client_id").cast("string"),
        "_branch": F.when(whole, F.lit("")).otherwise(F.col("branch").cast("string")),
    }
    banded = band_clients(clients.withColumns(added), risk.withColumns(added), keys, labels)
    return banded.drop("_client", "_branch")


def export_month(
    spark: SparkSession,
    root: str,
    out: str,
    period: str,
    contacts: DataFrame | None = None,
    file_format: str = "csv",
) -> None:
    """Write banded clients, product rows and contacts, a folder per table and country."""
    clients = _results(spark, root, "client_list", period)
    risk = _results(spark, root, "product_risk", period)
    # ``row_no`` tells a client's rows apart when the edited list comes back.
    banded = banded_lists(clients, risk).withColumn("row_no", F.col("call_rank"))
    tables = {"clients": banded, "reg": risk}
    if contacts is not None:
        tables["contacts"] = contacts
    export_tables(tables, out, file_format)


def reload_lists(spark: SparkSession, drop_folder: str, target: str) -> DataFrame:
    """Load edited lists of all countries for the next run; returns the rejected lines."""
    return load_feedback(read_feedback(spark, drop_folder), target)


def quarantined(spark: SparkSession, target: str) -> DataFrame:
    """Files that the last load held back, with the reasons."""
    return spark.read.parquet(f"{target}_quarantine")


def last_list(spark: SparkSession, target: str, country: str) -> DataFrame:
    """One country's edited list, for the next run's carry-over."""
    return spark.read.parquet(target).where(F.col("country") == country).drop("country")
