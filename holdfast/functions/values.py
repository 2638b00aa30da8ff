"""Projections: dates, sums, rounding, text repair."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdfast.spec import CodeOverride


def first_of_month(date: Column) -> Column:
    return F.trunc(date, "month").cast("date")


def parse_date(column: Column, pattern: str | None) -> Column:
    """A date from a native date column (no pattern), a padded text or a numeric day key."""
    if pattern is None:
        return column.cast("date")
    return F.to_date(F.trim(column.cast("string")), pattern)


def period_from(column: Column, pattern: str | None = None) -> Column:
    """The month of a raw date column, as the first day of that month."""
    return first_of_month(parse_date(column, pattern))


def period_text(period: Column) -> Column:
    return F.date_format(period, "yyyyMM")


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole calendar months from ``earlier`` to ``later``; the day is ignored."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


_BITS = 26
_STEP = float(1 << _BITS)
_LARGE = 2.0**78


def sum_parts(column: Column) -> tuple[Column, ...]:
    """A total as aggregates: whole numbers of 2**26, 1, 2**-26, 2**-52 and 2**-78, and a rest.

    Each value is cut into these parts without rounding, down to 2**-78 (3e-24), and whole
    numbers add up the same in any order.  Sums of plain longs stay in generated code,
    unlike decimals, and no part can overflow below 1e11 rows.  Values of 2**78 (3e23) or
    more, infinite ones among them, are added as doubles in the rest.  NaN counts as null.
    """
    value = F.nanvl(column.cast("double"), F.lit(None).cast("double"))
    usual = F.when(F.abs(value) < _LARGE, value)
    parts = []
    left = usual / _STEP
    for _ in range(5):
        part = left.cast("long")  # towards zero, so that what is left keeps all its bits
        parts.append(F.sum(part))
        left = (left - part) * _STEP
    return (*parts, F.sum(F.when(F.abs(value) >= _LARGE, value)))


def total_of(*sums: Column) -> Column:
    """The total of the parts; no value at all gives 0."""
    *parts, rest = [F.coalesce(c.cast("double"), F.lit(0.0)) for c in sums]
    total = parts[-1]
    for part in reversed(parts[:-1]):
        total = total / _STEP + part
    return total * _STEP + rest


def exact_sum(column: Column) -> Column:
    """A total that does not depend on the order of addition; no value at all gives 0."""
    return total_of(*sum_parts(column))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null, not an error, over zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_half_even(column: Column, digits: int = 0) -> Column:
    """Scale, round to the even whole number, scale back: binary rounding of doubles, not
    decimal rounding of their printed form."""
    scale = float(10**digits)
    return F.rint(column.cast("double") * scale) / scale


def to_whole(column: Column) -> Column:
    """Round half to even and store as an integer; null stays null."""
    return round_half_even(column, 0).cast("long")


def flag_to_int(column: Column, yes: str = "S") -> Column:
    """1 for the yes mark, 0 for everything else including null."""
    return (F.coalesce(column, F.lit("")) == F.lit(yes)).cast("int")


def repair_text(column: Column, repairs: Mapping[str, str]) -> Column:
    """Replace wrongly decoded labels; others pass through."""
    if not repairs:
        return column
    pairs = [F.lit(x) for item in repairs.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), column)


def override_by_code(target: Column, overrides: Iterable[CodeOverride]) -> Column:
    """Apply rules in order: a later matching rule wins over an earlier one."""
    result = target
    for rule in overrides:
        result = F.when(F.col(rule.code_column).isin(*rule.codes), F.lit(rule.value)).otherwise(
            result
        )
    return result


def class_from_prefix(column: Column, prefix: str, match: str, otherwise: str) -> Column:
    """A category read from the first characters of an id."""
    text = column.cast("string")
    return F.when(F.substring(text, 1, len(prefix)) == prefix, F.lit(match)).otherwise(
        F.lit(otherwise)
    )
