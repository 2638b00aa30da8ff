"""Repeatable pseudo-random order from the row key itself.

A seeded shuffle depends on how rows are spread over tasks; a hash of the key does not, so a
retried task or another cluster size draws the same sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_digest(keys: Sequence[str], seed: int) -> Column:
    """Hex md5 of the key values and a seed, joined by ``|``."""
    parts = [F.col(k).cast("string") for k in keys] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def digest_number(digest: Column, hex_digits: int = 6) -> Column:
    """The leading hex digits as an integer."""
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("long")


def unit_interval(keys: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) with 24 bits, fixed by the key."""
    return digest_number(key_digest(keys, seed), 6) / F.lit(float(16**6))
