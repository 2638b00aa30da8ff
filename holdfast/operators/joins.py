"""Joins to dimension tables and key sets.

No broadcast hint is given for tables that come from outside: the adaptive planner
broadcasts a side whose measured size is under its threshold and otherwise sorts and merges,
splitting hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.spec import Lookup


def lookup(df: DataFrame, table: DataFrame, spec: Lookup, null_safe: bool = False) -> DataFrame:
    """Left join on differently named keys, which are cast to the sales column's type.

    Null keys match nothing unless ``null_safe`` is set.
    """
    types = {f.name: f.dataType for f in df.schema}
    key_names = {b for _, b in spec.keys}
    take = dict(spec.take)
    if spec.rest:
        used = {*key_names, *take.values(), *df.columns}
        take |= {c: c for c in table.columns if c not in used}
    right = table.select(
        *[F.col(f"`{b}`").cast(types[a]).alias(f"_k{i}") for i, (a, b) in enumerate(spec.keys)],
        *[F.col(f"`{source}`").alias(f"_v_{new}") for new, source in take.items()],
    )
    if spec.distinct:
        right = right.distinct()
    conditions = []
    for i, (a, _) in enumerate(spec.keys):
        left_key, right_key = df[a], right[f"_k{i}"]
        conditions.append(left_key.eqNullSafe(right_key) if null_safe else left_key == right_key)
    joined = df.join(right, reduce(lambda x, y: x & y, conditions), "left")
    kept = [c for c in df.columns if c not in take]
    return joined.select(
        *[F.col(f"`{c}`") for c in kept], *[F.col(f"`_v_{new}`").alias(new) for new in take]
    )


def join_back(
    df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join a table that was aggregated by the same keys.

    The planner splits a hot key only where both sides arrive by an exchange made for the
    join, and would use the aggregate's own exchange here.  Spreading the table, one row per
    key, by all its columns makes it add one.
    """
    return df.join(table.repartition(*table.columns), list(on), how)


def join_same_type(
    df: DataFrame, table: DataFrame, on: Sequence[str], how: str, as_type: str
) -> DataFrame:
    """Join on keys that are first cast to one type on both sides."""
    cast = {c: F.col(c).cast(as_type) for c in on}
    return df.withColumns(cast).join(table.withColumns(cast), list(on), how)


def distinct_pairs(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations without nulls."""
    return df.select(*columns).na.drop().distinct()


def _distinct_keys(ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, dealt by more than the key so that the join adds an exchange of its
    own and can split a hot key of the other side (see ``join_back``)."""
    marked = ids.select(*keys).distinct().withColumn("_member", F.lit(1))
    return marked.repartition(*keys, "_member")


def keep_members(df: DataFrame, ids: DataFrame, on: str | Sequence[str]) -> DataFrame:
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(_distinct_keys(ids, keys), keys, "left_semi")


def drop_members(df: DataFrame, ids: DataFrame, on: str | Sequence[str]) -> DataFrame:
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(_distinct_keys(ids, keys), keys, "left_anti")


def newest_value(column: str, date: str) -> Column:
    """Aggregate: the newest non-null value; equal dates take the greatest value."""
    order = F.when(F.col(column).isNotNull(), F.struct(F.col(date), F.col(column)))
    return F.max_by(column, order).alias(column)


def latest_values(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], date: str
) -> DataFrame:
    """Per key, each column's newest non-null value.

    Lines are first reduced to one row per key and combination of values with its newest
    date.  That is a hash aggregate over numbers; picking text by date needs a sort, which
    then runs on the few combinations a key has, not on its lines.
    """
    seen = df.groupBy(*keys, *columns).agg(F.max(date).alias("_date"))
    return seen.groupBy(*keys).agg(*[newest_value(c, "_date") for c in columns])
