"""Joins whose left side may repeat one key any number of times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows to a table with one row per key, safe for hot keys on the left.

    Spark splits the partition of a hot key only where both inputs are shuffled
    for the join itself.  A right side fresh from a ``groupBy`` on the same keys
    would be used in place, which turns the split off.  Null-safe equality
    hashes differently, so both sides get their own shuffle and a hot key is
    spread over several tasks.  Null keys meet each other.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    taken, prefix = {c.lower() for c in [*left.columns, *right.columns]}, "_key_"
    while any(f"{prefix}{k}".lower() in taken for k in keys):
        prefix = f"_{prefix}"
    named = right.withColumnsRenamed({k: f"{prefix}{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys]
    return left.join(named, same, how).drop(*[f"{prefix}{k}" for k in keys])
