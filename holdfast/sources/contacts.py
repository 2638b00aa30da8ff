"""The contact table of markets that keep one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_contacts(df: DataFrame, renames: Mapping[str, str], id_column: str) -> DataFrame:
    """Distinct contact rows with output names and a whole-number id."""
    return (
        df.distinct()
        .withColumnsRenamed(dict(renames))
        .withColumn(id_column, F.col(id_column).cast("long"))
    )
