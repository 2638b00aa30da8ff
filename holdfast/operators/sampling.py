"""Class balance and train/test split, fixed by key hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.hashing import unit_interval
from holdfast.operators.ranking import rank_by_hash
from holdfast.spec import KEYS


def frequent(df: DataFrame, rare_until: int = 3) -> DataFrame:
    return df.where(F.col("frequency") > rare_until)


def balance_classes(
    df: DataFrame, rare_until: int = 3, seed: int = 11, keys: Sequence[str] = KEYS
) -> DataFrame:
    """All churners among frequent buyers, and as many of the others drawn by hash.

    If the others are fewer than the churners, all of them are kept.
    """
    df = frequent(df, rare_until)
    churned = df.where(F.col("target") == 1)
    stayed = rank_by_hash(
        df.where(F.col("target") == 0), keys, seed, "_rank", first=churned.count()
    )
    return churned.unionByName(stayed.drop("_rank"))


def split_by_hash(
    df: DataFrame, test_share: float = 0.20, seed: int = 42, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Adds ``part``: test or train.  Each row decides alone, so nothing is moved."""
    return df.withColumn(
        "part", F.when(unit_interval(keys, seed) < test_share, "test").otherwise("train")
    )
