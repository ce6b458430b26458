"""Stratified sampling with an exact total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldatlas.operators.ranking import first_rows, with_position
from fieldatlas.session import Scratch


def allocate(sizes: DataFrame, key: str, limit: int, scratch: Scratch) -> DataFrame:
    """Seats per stratum: one each, the rest by largest remainder of what is left.

    ``sizes`` has the key and ``n_docs``; the result adds ``take``.  All shares
    are exact integer arithmetic.
    """
    total, strata = sizes.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.count(F.lit(1))).first()
    if total <= limit:
        return sizes.withColumn("take", F.col("n_docs"))
    if strata > limit:
        raise ValueError(f"{strata} strata do not fit into a sample of {limit}")
    seats, room = limit - strata, total - strata
    product = f"cast({seats} as decimal(38,0)) * (n_docs - 1)"
    share = scratch.save(sizes.withColumn("_whole", F.expr(f"({product}) div {room}")).withColumn(
        "_rest", F.expr(f"cast({product} - cast(_whole as decimal(38,0)) * {room} as bigint)")))
    spare = seats - share.agg(F.sum("_whole")).first()[0]
    # strata of one row have no room left; they sort last because their rest is 0
    placed = with_position(share, [(F.col("n_docs") > 1).desc(), F.col("_rest").desc(),
                                   F.col("n_docs").desc(), F.col(key).asc()], "_pos", scratch)
    extra = F.when((F.col("_pos") < spare) & (F.col("n_docs") > 1), 1).otherwise(0)
    return placed.select(key, "n_docs", (1 + F.col("_whole") + extra).alias("take"))


def stratified_sample(df: DataFrame, key: str, row_id: str, limit: int, seed: int,
                      scratch: Scratch) -> DataFrame:
    """At most ``limit`` rows, every stratum represented in proportion.

    Rows of a stratum are taken in the order of md5('seed:id').
    """
    sizes = scratch.save(df.groupBy(key).agg(F.count(F.lit(1)).alias("n_docs")))
    seats = allocate(sizes, key, limit, scratch)
    dice = F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))
    # 65,536 equally likely beginnings, so that few rows of a stratum share the one at the cut
    return first_rows(df, key, F.substring(dice, 1, 4), [dice.asc(), F.col(row_id).asc()], seats, scratch)
