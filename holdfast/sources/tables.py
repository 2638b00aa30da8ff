"""One reader for files, catalog tables and JDBC, and the two scan filters used on them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableRef:
    """Where a table is.

    ``kind`` is ``table`` (catalog name), ``jdbc`` (``name`` is the table or sub-query and
    ``options`` hold url, user, password and driver from the caller) or a file format.
    For JDBC give ``partition_column``, ``lower``, ``upper`` and ``partitions``, otherwise
    the whole table is read by one task.
    """

    name: str
    kind: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: StructType | str | None = None
    partition_column: str | None = None
    lower: str | None = None
    upper: str | None = None
    partitions: int = 1


def read_table(spark: SparkSession, ref: TableRef) -> DataFrame:
    if ref.kind == "table":
        return spark.table(ref.name)
    if ref.kind == "jdbc":
        reader = spark.read.format("jdbc").options(**ref.options).option("dbtable", ref.name)
        if ref.partition_column:
            reader = (
                reader.option("partitionColumn", ref.partition_column)
                .option("lowerBound", ref.lower)
                .option("upperBound", ref.upper)
                .option("numPartitions", ref.partitions)
            )
        return reader.load()
    reader = spark.read.format(ref.kind).options(**ref.options)
    if ref.schema is not None:
        reader = reader.schema(ref.schema)
    return reader.load(ref.name)


def window_start(as_of, months: int = 27) -> Column:
    """First day of the month ``months`` before the month of ``as_of``."""
    return F.add_months(F.trunc(F.lit(as_of).cast("date"), "month"), -months)


def month_marks(start: dt.date) -> list[str]:
    """Texts of which every ``dd/MM/yyyy`` or ``MM/yyyy`` date from the month of ``start`` on
    holds one, and no earlier date any.

    The months left of that year are listed.  Later years differ from it in one digit first,
    which is higher: the digits up to there, behind a slash, stand for all of them, so the
    list is short and has no end date.
    """
    year = f"{start.year:04d}"
    marks = [f"{month:02d}/{year}" for month in range(start.month, 13)]
    for place in reversed(range(4)):
        marks += [f"/{year[:place]}{digit}" for digit in range(int(year[place]) + 1, 10)]
    return marks


def _window_start(as_of: dt.date | str, months: int) -> dt.date:
    day = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    count = day.year * 12 + day.month - 1 - months
    return dt.date(count // 12, count % 12 + 1, 1)


def trailing_months(
    df: DataFrame,
    date_column: str,
    as_of: dt.date | str,
    months: int = 27,
    pattern: str | None = None,
    after: bool = False,
) -> DataFrame:
    """Rows from the last ``months`` months, with ``after`` less the first day of them.

    A native date column is compared bare, and a day key of pattern ``yyyyMMdd`` as a
    number, so both reach the source's own filter.  Text of pattern ``dd/MM/yyyy`` or
    ``MM/yyyy`` has no such order; the source is asked for the texts that hold one of the
    window's ``month_marks``, and only what it returns is parsed.  Other text dates are
    parsed first.
    """
    start = F.date_add(window_start(as_of, months), 1 if after else 0)
    column = F.col(date_column)
    if pattern is None:
        return df.where(column >= start)
    if pattern == "yyyyMMdd":
        return df.where(column >= F.date_format(start, pattern).cast("int"))
    if pattern in ("dd/MM/yyyy", "MM/yyyy"):
        marks = [column.contains(m) for m in month_marks(_window_start(as_of, months))]
        df = df.where(reduce(lambda a, b: a | b, marks))
    return df.where(F.to_date(F.trim(column), pattern) >= start)


def one_month(df: DataFrame, date_column: str, month: dt.date | str) -> DataFrame:
    """Rows of a native date column's month, by two bare comparisons that reach the source."""
    first, column = F.trunc(F.lit(month).cast("date"), "month"), F.col(date_column)
    return df.where((column >= first) & (column < F.add_months(first, 1)))


def period_slice(
    df: DataFrame, period: str, period_column: str = "period", countries: list[str] | None = None
) -> DataFrame:
    """One month of a result table that is stored by country and period.

    Both tests are on partition columns, so only the matching folders are read.
    """
    df = df.where(F.col(period_column) == F.lit(period))
    return df.where(F.col("country").isin(*countries)) if countries else df
