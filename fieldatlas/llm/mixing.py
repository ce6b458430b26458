"""Mixing sources to target weights over a tree such as domain > language > source.

A node's share of its parent's tokens follows its weight but never exceeds what
its subtree can give in ``max_epochs`` passes; what a node cannot fill goes to
its siblings in proportion to their weights.  A subtree's capacity is the sum of
its leaves, so a leaf's shortage is met by its own siblings first and reaches
the next level up only when they are exhausted.  Each leaf then takes whole
epochs and, of one more epoch in seeded order, the prefix that fills its budget.

Only DataFrame functions run here.  No leaf is ever gathered: prefixes are cut
by token sums of hash buckets, and rows are ordered inside one bucket only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldatlas.operators.joins import lookup
from fieldatlas.session import Scratch

WORD = r"[^\x20\x09-\x0D]+"
_BUCKET_DIGITS = 3  # 4,096 buckets of the seeded order in each leaf


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, float]) -> Column:
    given = F.lit(None).cast("double")
    for value, weight in weights.items():
        given = F.when(F.col(level) == value, F.lit(float(weight))).otherwise(given)
    return F.coalesce(given, F.lit(1.0))


def shared_out(nodes: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Split ``budget`` of each parent over its rows ``weight, capacity``: adds ``share``.

    The rows that cannot fill their part are a prefix in the order of capacity to
    weight, so one running sum finds the common level of all others.
    """
    usable = nodes.where("weight > 0").withColumn("_ratio", F.col("capacity") / F.col("weight"))
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    path = [c for c in nodes.columns if c not in ("weight", "capacity", "budget")]
    line = group.orderBy("_ratio", *path)
    before = F.coalesce(F.sum("capacity").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(line.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    short = usable.withColumn("_short", F.col("capacity") * rest <= F.col("weight") * (F.col("budget") - before))
    filled = F.coalesce(F.sum(F.when(F.col("_short"), F.col("capacity"))).over(group), F.lit(0))
    open_weight = F.sum(F.when(~F.col("_short"), F.col("weight"))).over(group)
    return short.withColumn("share", F.when(F.col("_short"), F.col("capacity").cast("double"))
                            .otherwise(F.col("weight") * ((F.col("budget") - filled) / open_weight))) \
                .drop("_ratio", "_short")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]],
                 budget_share: float, max_epochs: int) -> DataFrame:
    """Levels, ``tokens`` and ``budget`` (long) of every leaf; ``leaves`` has the levels and ``tokens``."""
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first()["t"]
    parents = None
    for depth in range(1, len(levels) + 1):
        path = list(levels[:depth])
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("capacity")) \
                      .withColumn("weight", _weight(path[-1], weights.get(path[-1], {})))
        if parents is None:
            nodes = nodes.withColumn("budget", F.lit(float(int(budget_share * total))))
        else:
            nodes = lookup(nodes, parents, path[:-1])
        parents = shared_out(nodes, path[:-1]).select(*path, F.col("share").alias("budget"))
    return lookup(leaves, parents, list(levels), "left").withColumn(
        "budget", F.coalesce(F.floor("budget"), F.lit(0)).cast("long"))


def selected(documents: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]],
             budget_share: float, max_epochs: int, seed: int, scratch: Scratch) -> DataFrame:
    """``_tag``, ``doc_id``, the levels, ``n_tokens`` and ``copies`` (0 to ``max_epochs``) of every distinct row.

    ``levels`` are columns of ``documents``, root first; a null value is a node
    of its own.  Rows equal in id, text and levels are taken or left together.
    Null and empty texts have no tokens and follow their place in the order.
    """
    tagged = documents.select("doc_id", *levels, n_words(F.col("text")).alias("n_tokens"),
                              row_key(levels).alias("_tag"))
    sized = scratch.save(tagged.groupBy("_tag", "doc_id", *levels, "n_tokens")
                         .agg((F.count(F.lit(1)) * F.col("n_tokens")).alias("_tokens")))
    leaves = scratch.save(sized.groupBy(*levels).agg(F.sum("_tokens").alias("tokens")))
    budgets = leaf_budgets(leaves, levels, weights, budget_share, max_epochs)
    full = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long")
    plan = scratch.save(budgets.select(*levels, full.alias("_full"), (F.col("budget") - full * F.col("tokens"))
                                       .alias("_rest")))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_full").cast("string"), F.col("doc_id").cast("string")))
    placed = scratch.save(lookup(sized, plan, list(levels)).withColumn("_order", order)
                          .withColumn("_bucket", F.substring("_order", 1, _BUCKET_DIGITS)))
    sums = placed.groupBy(*levels, "_bucket").agg(F.sum("_tokens").alias("_sum"))
    earlier = Window.partitionBy(*levels).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    rows = lookup(placed, sums, [*levels, "_bucket"])
    inside = Window.partitionBy(*levels, "_bucket").orderBy("_order", "doc_id", "_tag") \
                   .rowsBetween(Window.unboundedPreceding, -1)
    cut = (F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_sum") >= F.col("_rest"))
    edge = rows.where(cut).withColumn("_before", F.col("_before") + F.coalesce(F.sum("_tokens").over(inside), F.lit(0)))
    taken = (F.col("_before") < F.col("_rest")).cast("long")
    return rows.where(~cut).unionByName(edge).select("_tag", "doc_id", *levels, "n_tokens",
                                                     (F.col("_full") + taken).cast("int").alias("copies"))


def row_key(levels: Sequence[str]) -> Column:
    return F.xxhash64("doc_id", "text", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in levels])


def mixed(documents: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, float]],
          budget_share: float, max_epochs: int, seed: int, scratch: Scratch) -> DataFrame:
    """The documents, each as often as its leaf's epochs select it; ``levels`` maps names to expressions."""
    names = [f"_level_{name}" for name in levels]
    tagged = documents.withColumns(dict(zip(names, levels.values(), strict=True)))
    renamed = {f"_level_{k}": v for k, v in weights.items()}
    copies = selected(tagged, names, renamed, budget_share, max_epochs, seed, scratch) \
        .where("copies > 0").select(F.col("_tag"), F.col("copies").alias("_copies"))
    rows = lookup(tagged.withColumn("_tag", row_key(names)), scratch.save(copies), "_tag")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*documents.columns)
