"""Categories as codes from a dictionary table, without their values on the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators.ranking import top_per_group

#: Values of one column that get a code of their own; all others share one.
MOST_VALUES = 4_096


def category_dictionary(
    df: DataFrame,
    columns: Sequence[str],
    least_rows: int = 1,
    most_values: int = MOST_VALUES,
) -> DataFrame:
    """``column``, ``value``, ``n`` and ``code``: the values of each column that occur in
    ``least_rows`` rows or more, at most ``most_values``, numbered from 0 by falling count,
    then value.

    All columns are counted in one pass, a row per value and task before the exchange.  The
    most frequent values are found by parts of the values' hash, so that no task sees all
    values of a column.
    """
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    counts = (
        df.select(F.inline(cells))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_rows)
    )
    order = [F.desc("n"), F.asc("value")]
    ranked = top_per_group(counts, "column", order, most_values, ["value"], "_rank")
    return ranked.select("column", "value", "n", (F.col("_rank") - 1).cast("int").alias("code"))


def dictionary_sizes(dictionary: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Codes per column, one number each."""
    found = dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {r["column"]: r["n"] for r in found}
    return {c: sizes.get(c, 0) for c in columns}


def code_name(column: str) -> str:
    return f"_{column}_code"


def encode_categories(
    df: DataFrame, dictionary: DataFrame, sizes: Mapping[str, int]
) -> DataFrame:
    """Adds each column's code.  A value without one, rare or never seen, has the next number
    after the codes, and null the number after that.

    The dictionary holds at most ``MOST_VALUES`` rows a column, so it is broadcast.  The codes
    carry their number of values for the one-hot encoder, which needs nothing else.
    """
    for column, size in sizes.items():
        name = code_name(column)
        codes = dictionary.where(F.col("column") == column).select(
            F.col("value").alias("_value"), F.col("code").alias("_code")
        )
        code = F.when(F.col(column).isNull(), size + 1).otherwise(F.coalesce("_code", F.lit(size)))
        nominal = {"ml_attr": {"type": "nominal", "num_vals": size + 2, "name": name}}
        df = (
            df.join(F.broadcast(codes), F.col(column).cast("string") == F.col("_value"), "left")
            .withColumn(name, code.cast("double").alias(name, metadata=nominal))
            .drop("_value", "_code")
        )
    return df
