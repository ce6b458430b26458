"""Ranks and positions that never gather one group into one task.

``top_n`` relies on Spark's group limit: each map task forwards at most ``n``
rows of a group, so a hot key stays small.  Unbounded ranks come from one
range-partitioned sort, whose partitions are balanced by row count whatever the
keys look like; positions are then offset per sort partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldatlas.operators.joins import lookup
from fieldatlas.session import Scratch

# monotonically_increasing_id keeps the partition number above bit 33.
_POSITION_BITS = 33


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
          rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows of each group in the given order.

    Map tasks forward at most n rows of a group, for any n below the optimizer's
    limit, which the session settings raise.
    """
    name = rank_col or "_rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def with_position(df: DataFrame, order: Sequence[Column], name: str, scratch: Scratch) -> DataFrame:
    """Add the 0-based position of each row in one total order."""
    numbered = scratch.save(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()))
    part = F.shiftright("_slot", _POSITION_BITS)
    # One row per sort partition, so the window below and the broadcast are
    # bounded by the number of tasks, not by the data.
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + inside)
        .drop("_part", "_offset", "_slot")
    )


def with_group_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str,
                    scratch: Scratch, size_col: str | None = None) -> DataFrame:
    """Add the 1-based rank inside each group, for groups of any size."""
    placed = with_position(df, [F.col(k).asc_nulls_last() for k in keys] + list(order), "_pos", scratch)
    starts = placed.groupBy(*keys).agg(F.min("_pos").alias("_first"),
                                       F.count(F.lit(1)).alias("_members"))
    out = lookup(placed, starts, keys)
    out = out.withColumn(name, F.col("_pos") - F.col("_first") + 1)
    if size_col:
        out = out.withColumn(size_col, F.col("_members"))
    return out.drop("_pos", "_first", "_members")


def first_rows(df: DataFrame, key: str, coarse: Column, order: Sequence[Column], takes: DataFrame,
               scratch: Scratch) -> DataFrame:
    """First rows of each group, as many as ``take`` in ``takes`` (``key, take``) says, without sorting the groups.

    ``coarse`` grows with ``order`` and is never null.  Its counts per group fold
    before the shuffle and tell where each group is cut; only the rows at the cut
    are ranked.  Rows beyond it are never moved.
    """
    rows = df.withColumn("_coarse", coarse)
    counts = rows.groupBy(key, "_coarse").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_coarse").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    cuts = lookup(counts, takes.select(key, "take"), key).where("_before < take").groupBy(key).agg(
        F.max(F.struct("_coarse", (F.col("take") - F.col("_before")).alias("left"))).alias("_cut"))
    near = scratch.save(lookup(rows, cuts, key).where("_coarse <= _cut._coarse"))
    ties = near.where("_coarse = _cut._coarse").withColumn(
        "_turn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_turn <= _cut.left")
    return near.where("_coarse < _cut._coarse").unionByName(ties.drop("_turn")).drop("_coarse", "_cut")


def dense_index(df: DataFrame, key: str, name: str, scratch: Scratch) -> DataFrame:
    """Distinct non-null keys with dense 0-based ids in key order."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return with_position(keys, [F.col(key).asc()], name, scratch).select(name, key)


def percent_rank_table(df: DataFrame, key: str, value: str, weight: Column | None = None) -> DataFrame:
    """Percent rank of every distinct (key, value), nulls last; lone rows get 0.5.

    The rows are first folded to one count per distinct value, so the window
    sees the histogram of a group and never its rows.
    """
    counts = df.groupBy(key, value).agg(F.sum(weight if weight is not None else F.lit(1)).alias("_n"))
    group = Window.partitionBy(key)
    lower = group.orderBy(F.col(value).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_n").over(group)
    below = F.coalesce(F.sum("_n").over(lower), F.lit(0))
    return counts.select(
        key, value, "_n",
        F.when(total == 1, F.lit(0.5)).otherwise(below / (total - 1)).alias("paper_rank"),
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return top_n(df, keys, order, 1)


def group_median(df: DataFrame, keys: Sequence[str], value: str, name: str, scratch: Scratch) -> DataFrame:
    """Interpolated median per group; reads only the middle one or two ranked rows."""
    ranked = with_group_rank(df.where(F.col(value).isNotNull()).select(*keys, value), keys,
                             [F.col(value).asc()], "_rank", scratch, size_col="_size")
    middle = F.col("_rank").between(F.floor((F.col("_size") + 1) / 2), F.floor(F.col("_size") / 2) + 1)
    return ranked.where(middle).groupBy(*keys).agg(F.avg(value).alias(name))
