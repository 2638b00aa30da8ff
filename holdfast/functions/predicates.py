"""Filter conditions with the null rules of a data-frame library rather than of SQL.

SQL's ``NOT IN`` and ``<>`` drop rows whose column is null.  The retention rules keep
them, so each negative test below is written to be true for null.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.spec import Rule


def in_list(column: Column, values: Iterable) -> Column:
    return column.isin(*values)


def not_in_keep_null(column: Column, values: Iterable) -> Column:
    return ~F.coalesce(column.isin(*values), F.lit(False))


def in_list_or_null(column: Column, values: Iterable) -> Column:
    return column.isin(*values) | column.isNull()


def differs_keep_null(column: Column, value) -> Column:
    return ~column.eqNullSafe(F.lit(value))


def in_closed_window(period: Column, end: Column, months: int) -> Column:
    """``[end - months, end]``."""
    return (period >= F.add_months(end, -months)) & (period <= end)


def in_half_open_window(period: Column, end: Column, months: int) -> Column:
    """``(end - months, end]``."""
    return (period > F.add_months(end, -months)) & (period <= end)


def in_previous_month(date: Column, as_of) -> Column:
    """True inside the calendar month before ``as_of``.

    Written as a range on the bare column so that a scan can use it.
    """
    month = F.trunc(F.lit(as_of).cast("date"), "month")
    return (date >= F.add_months(month, -1)) & (date < month)


_TESTS = {
    "in": in_list,
    "not_in": not_in_keep_null,
    "in_or_null": in_list_or_null,
    "not_null": lambda c, _: c.isNotNull(),
}


def rule_condition(rule: Rule) -> Column:
    return _TESTS[rule.test](F.col(rule.column), rule.values)


def apply_rules(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Keep the rows that satisfy every rule, as one filter."""
    conditions = [rule_condition(r) for r in rules]
    return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df
