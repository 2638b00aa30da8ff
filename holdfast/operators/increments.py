"""Monthly sums that are stored once and merged, in place of all lines read every month.

A month's lines are reduced to partial sums per client, product, branch and month, kept in a
folder per month.  The sums are the whole-number parts of ``exact_sum``, so merging them gives
to the last bit what the lines themselves give, in whatever order they were loaded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.predicates import apply_rules
from holdfast.functions.values import period_text, sum_parts, total_of
from holdfast.operators.activity import newest_period
from holdfast.session import delete_path, path_exists
from holdfast.spec import KEYS, Rule

GRAIN = (*KEYS, "period")


def _part_names(name: str) -> list[str]:
    return [f"{name}_{i}" for i in range(6)]


def _sum_columns(column: str, name: str) -> list[Column]:
    return [part.alias(n) for part, n in zip(sum_parts(F.col(column)), _part_names(name))]


def _merged(name: str) -> Column:
    return total_of(*[F.sum(n) for n in _part_names(name)]).alias(name)


def _first(month: dt.date | str) -> Column:
    return F.trunc(F.lit(month).cast("date"), "month")


@dataclass
class MonthlyParts:
    """Partial sums of one market's lines under ``root``, a folder per month.

    ``activity`` has the sums per client, product, branch and month of the lines in scope;
    ``totals`` those per client and branch of the lines that count as sales, which may be
    others.  Loading a month again replaces it, so a failed or repeated load does no harm.
    """

    spark: SparkSession
    root: str
    measures: Mapping[str, str] = field(default_factory=lambda: {"monetary_value": "amount"})
    total_rules: Sequence[Rule] = ()
    total_branch: str = "branch"

    def load(self, scoped: DataFrame, counted: DataFrame) -> None:
        """Take in whole months of lines, each in place of what is stored of that month:
        those in scope, and those that totals count."""
        sums = [c for name, source in self.measures.items() for c in _sum_columns(source, name)]
        dated = scoped.where(F.col("period").isNotNull())
        activity = dated.groupBy(*GRAIN).agg(
            *sums, *_sum_columns("volume", "volume"), F.count("sale_date").alias("dated")
        )
        counted = apply_rules(counted, self.total_rules).where(F.col("period").isNotNull())
        branch = F.col(self.total_branch).alias("branch")
        sold = F.trunc("sale_date", "month").cast("date").alias("sold")
        totals = counted.groupBy("client_id", branch, "period", sold).agg(
            *_sum_columns("amount", "sales_12m")
        )
        for name, parts in (("activity", activity), ("totals", totals)):
            (
                parts.withColumn("month", period_text(F.col("period")))
                .hint("rebalance", "month")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("month")
                .parquet(f"{self.root}/{name}")
            )

    def drop_before(self, as_of: dt.date, months: int = 27) -> list[str]:
        """Delete the months that a window of ``months`` before ``as_of`` no longer holds."""
        oldest = (as_of.year * 12 + as_of.month - 1) - months
        oldest = f"{oldest // 12:04d}{oldest % 12 + 1:02d}"
        gone = set()
        for name in ("activity", "totals"):
            if not path_exists(self.spark, f"{self.root}/{name}"):
                continue
            # Folder names only: no file is opened for this.
            stored = self._read(name).select("month").distinct().collect()
            for month in sorted(r["month"] for r in stored if r["month"] < oldest):
                delete_path(self.spark, f"{self.root}/{name}/month={month}")
                gone.add(month)
        return sorted(gone)

    def _read(self, name: str) -> DataFrame:
        found = self.spark.read.parquet(f"{self.root}/{name}")
        return found.withColumn("month", F.col("month").cast("string"))

    def _window(self, name: str, as_of: dt.date | str, months: int) -> DataFrame:
        """Stored months of the window, tested on the folder names."""
        first, end = F.add_months(_first(as_of), -months), _first(as_of)
        month = F.col("month")
        return self._read(name).where((month >= period_text(first)) & (month < period_text(end)))

    def activity(self, as_of: dt.date | str, months: int = 27) -> DataFrame:
        """What ``monthly_activity`` makes of all lines of the ``months`` months before the
        month of ``as_of``, which is not complete yet and no part of it."""
        merged = [_merged(name) for name in self.measures]
        return (
            self._window("activity", as_of, months)
            .na.drop(subset=list(GRAIN))
            .groupBy(*GRAIN)
            .agg(*merged, (F.sum("dated") >= 1).cast("int").alias("frequency"), _merged("volume"))
        )

    def sales_total(
        self, as_of: dt.date | str, months: int = 12, history: int = 27
    ) -> DataFrame:
        """What ``sales_total`` makes of those lines: sales per client and branch over the
        ``months`` months up to the newest one stored."""
        parts = self._window("totals", as_of, history)
        start = F.add_months(newest_period(parts), -(months - 1))
        return (
            parts.na.drop(subset=["client_id", "branch"])
            .where(F.col("sold") >= start)
            .groupBy("client_id", "branch")
            .agg(_merged("sales_12m"))
        )
