"""Keywords and vectors of each cluster from its representative works."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldatlas.operators.joins import lookup
from fieldatlas.operators.ranking import first_rows, top_n
from fieldatlas.operators.selection import restrict
from fieldatlas.session import Scratch


def representatives(articles: DataFrame, scratch: Scratch, floor: int = 5, percent: int = 1) -> DataFrame:
    """Most cited titled works of each micro cluster: ``percent`` of it, at least ``floor``."""
    titled = articles.where(F.col("micro_cluster").isNotNull() & F.col("title").isNotNull())
    # ids alone are selected and written; the chosen works' other columns are fetched afterwards
    ids = scratch.save(titled.select("id", "micro_cluster", "citations"))
    sizes = ids.groupBy("micro_cluster").agg(F.count(F.lit(1)).alias("n"))
    takes = sizes.select("micro_cluster", F.greatest(F.lit(floor), F.floor((F.col("n") * percent + 99) / 100)).alias("take"))
    rarity = F.struct(F.col("citations").isNull(), -F.coalesce("citations", F.lit(0)))
    chosen = first_rows(ids, "micro_cluster", rarity, [F.col("id").asc()], takes, scratch).select("id").distinct()
    return restrict(titled, chosen, "id")


# --- class keywords ----------------------------------------------------------

# Fixed value: a token is a run of at least two letters, digits or underscores.
TOKEN = r"([\p{L}\p{N}_]{2,})"


def words(text: Column, stop_words: Sequence[str]) -> Column:
    """Lower-cased tokens of a text without stop words."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(1))
    return F.filter(found, lambda w: ~w.isin(*stop_words)) if stop_words else found


def word_pairs(found: Column) -> Column:
    """Neighbouring words joined by a space."""
    rest = F.greatest(F.size(found) - 1, F.lit(0))
    return F.zip_with(F.slice(found, 1, rest), F.slice(found, 2, rest),
                      lambda left, right: F.concat_ws(" ", left, right))


def english_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def class_keywords(docs: DataFrame, label: str, text: str, scratch: Scratch, top: int = 10,
                   min_df: int = 1, stop_words: Sequence[str] | None = None) -> DataFrame:
    """Most distinctive terms of each class: rows ``cluster, keywords``.

    Class TF-IDF (Grootendorst 2022): square root of the share of a term in its
    class, times ln(1 + mean class size / total count of the term).  ``min_df``
    counts classes.  The class id is the group key throughout.
    """
    stop = english_stop_words() if stop_words is None else list(stop_words)
    term = Window.partitionBy("term")
    counts = (
        docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).hint("rebalance")
        .select(F.col(label).alias("cluster"), words(F.col(text), stop).alias("_words"))
        .select("cluster", F.explode(F.concat("_words", word_pairs(F.col("_words")))).alias("term"))
        .groupBy("cluster", "term").agg(F.count(F.lit(1)).alias("n")))
    # a term has at most one row a class, so no window holds more rows than there are classes
    kept = scratch.save(counts.withColumns({"total": F.sum("n").over(term), "classes": F.count(F.lit(1)).over(term)})
                        .where(F.col("classes") >= min_df).drop("classes"))
    # written first, so that its size is known and the terms of a few large classes stay where they are
    sizes = scratch.save(kept.groupBy("cluster").agg(F.sum("n").alias("size")))
    mean_size = sizes.agg(F.floor(F.avg("size"))).first()[0] or 0
    score = F.sqrt(F.col("n") / F.col("size")) * F.log(F.lit(1.0) + F.lit(float(mean_size)) / F.col("total"))
    scored = lookup(kept, sizes, "cluster").select("cluster", "term", F.round(score, 9).alias("score"))
    best = top_n(scored, ["cluster"], [F.col("score").desc(), F.col("term").asc()], top, "rank")
    listed = best.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("t"))
    return listed.select("cluster", F.array_join(F.col("t.term"), ", ").alias("keywords"))
