"""Raw market lines to role columns, then to the lines in scope."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.predicates import apply_rules
from holdfast.functions.values import (
    class_from_prefix,
    flag_to_int,
    override_by_code,
    parse_date,
    period_from,
    repair_text,
)
from holdfast.operators.joins import lookup
from holdfast.spec import CodeOverride, MarketSpec, Remap


def to_roles(raw: DataFrame, spec: MarketSpec) -> DataFrame:
    """Give role names to raw columns; columns without a role keep their name."""
    by_raw: dict[str, list[str]] = {}
    for role, source in spec.columns.items():
        if source in raw.columns:  # other roles come from a dimension table
            by_raw.setdefault(source, []).append(role)
    out = []
    for name in raw.columns:
        quoted = F.col(f"`{name}`")
        out += [quoted.alias(role) for role in by_raw.get(name, [name])]
    return raw.select(*out)


def clean_roles(df: DataFrame, spec: MarketSpec) -> DataFrame:
    """Trim and cast keys, parse dates, set the period, repair labels: one projection."""
    changes = {c: F.trim(F.col(c)) for c in spec.trimmed}
    changes |= {c: F.col(c).cast("long") for c in spec.long_ids}
    for column, repairs in spec.text_repairs.items():
        changes[column] = repair_text(F.col(column), repairs)
    if spec.id_class:
        new, source, prefix, match, otherwise = spec.id_class
        changes[new] = class_from_prefix(F.col(source), prefix, match, otherwise)
    changes["sale_date"] = parse_date(F.col("sale_date"), spec.date_pattern)
    if spec.period_from:
        column, pattern = spec.period_from
        changes["period"] = period_from(F.col(column), pattern)
    else:
        changes["period"] = period_from(F.col("sale_date"), spec.date_pattern)
    return df.withColumns(changes)


def apply_overrides(df: DataFrame, overrides: tuple[CodeOverride, ...]) -> DataFrame:
    targets: dict[str, list[CodeOverride]] = {}
    for rule in overrides:
        targets.setdefault(rule.target, []).append(rule)
    return df.withColumns(
        {t: override_by_code(F.col(t), rules) for t, rules in targets.items()}
    )


def remap_values(df: DataFrame, table: DataFrame, remap: Remap) -> DataFrame:
    """Replace a column by the reference table's value where it has one."""
    mapped = table.select(
        F.col(remap.key[1]).alias("_key"), F.col(remap.new_value).alias("_new")
    ).distinct()
    return (
        df.join(mapped, F.col(remap.key[0]) == F.col("_key"), "left")
        .withColumn(remap.target, F.coalesce("_new", remap.target))
        .drop("_key", "_new")
    )


def set_flags(df: DataFrame, flags: tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: flag_to_int(F.col(c)) for c in flags})


def fill_numeric(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill nulls in the named columns only, each with a value of its own type."""
    return df.na.fill(dict(values))


def prepare_sales(raw: DataFrame, spec: MarketSpec, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Raw lines in role columns with dimensions attached; totals are taken from these."""
    df = apply_overrides(clean_roles(to_roles(raw, spec), spec), spec.overrides)
    df = apply_rules(df, spec.raw_rules)
    for item in spec.lookups:
        if item.at == "raw":
            df = lookup(df, tables[item.table], item)
    return df


def scope_sales(df: DataFrame, spec: MarketSpec, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The lines that enter the churn computation."""
    for item in spec.lookups:
        if item.at == "scope":
            df = lookup(df, tables[item.table], item)
    df = df.withColumns({c: F.trim(F.col(c)) for c in spec.scope_trimmed})
    df = apply_rules(df, spec.scope_rules)
    if spec.drop_duplicate_lines:
        df = df.dropDuplicates()
    if spec.remap:
        df = remap_values(df, tables[spec.remap.table], spec.remap)
    return apply_rules(df, spec.remap_rules)
