"""Enriched, sampled work texts with their macro cluster's name and colour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldatlas.functions import text
from fieldatlas.functions.colors import stored_or_stable
from fieldatlas.operators.joins import lookup
from fieldatlas.operators.ranking import first_per_key, with_position
from fieldatlas.operators.sampling import stratified_sample
from fieldatlas.operators.selection import restrict
from fieldatlas.session import Scratch

RECORD_COLUMNS = ("paper_id", "micro_cluster", "macro_cluster", "display_id", "macro_name", "color_hex",
                  "title", "text_enriched", "abstract")


def backfill(docs: DataFrame, others: Sequence[DataFrame], key: str = "id",
             value: str = "abstract") -> DataFrame:
    """Fill blank values from other tables in turn; of several non-blank values the smallest counts."""
    out = docs.withColumn(value, text.blank_to_null(F.col(value)))
    for other in others:
        known = other.select(key, text.blank_to_null(F.col(value)).alias("_other")) \
                     .where("_other is not null").groupBy(key).agg(F.min("_other").alias("_other"))
        out = lookup(out, known, key, "left").withColumn(value, F.coalesce(value, "_other")).drop("_other")
    return out


def backfill_counts(before: DataFrame, after: DataFrame, value: str = "abstract") -> DataFrame:
    """Rows with a value before and after filling."""
    def known(df: DataFrame, name: str) -> DataFrame:
        present = text.blank_to_null(F.col(value)).isNotNull()
        return df.agg(F.lit(1).alias("_one"), F.count(F.lit(1)).alias(f"rows_{name}"),
                      F.count_if(present).alias(f"filled_{name}"))
    return known(before, "before").join(known(after, "after"), "_one").drop("_one")


def with_macro_facts(docs: DataFrame, names: DataFrame, colors: DataFrame, report: DataFrame) -> DataFrame:
    """Add macro name, colour and size, with defaults where a table has no row."""
    macro = F.col("macro_cluster")
    for facts, column in ((names, "name"), (colors, "color_hex"), (report, "publications")):
        one = facts.select("macro_cluster", column)
        docs = docs.join(first_per_key(one, ["macro_cluster"], [F.col(column).asc_nulls_last()]),
                         "macro_cluster", "left")
    default: Column = F.concat(F.lit("Macro "), macro.cast("string"))
    return docs.withColumns({
        "name": F.coalesce(text.blank_to_null(F.col("name")), default),
        "color_hex": stored_or_stable(F.col("color_hex"), macro),
        "publications": F.coalesce(F.col("publications").try_cast("bigint"), F.lit(0))})


def macro_display(docs: DataFrame, names: DataFrame, colors: DataFrame, report: DataFrame,
                  scratch: Scratch) -> DataFrame:
    """Macro clusters of the documents by document count, numbered from 1."""
    counts = docs.groupBy("macro_cluster").agg(F.count(F.lit(1)).alias("subquery_documents"))
    placed = with_position(counts, [F.col("subquery_documents").desc(), F.col("macro_cluster").asc()],
                           "_pos", scratch)
    facts = with_macro_facts(placed, names, colors, report)
    return facts.select("macro_cluster", "subquery_documents", (F.col("_pos") + 1).alias("display_id"),
                        F.col("name").alias("macro_name"), "color_hex",
                        F.col("publications").alias("macro_publications_global"))


def records(articles: DataFrame, chosen: DataFrame, names: DataFrame, colors: DataFrame,
            macro_report: DataFrame, scratch: Scratch, fallbacks: Sequence[DataFrame] = (),
            *, limit: int, with_abstract: bool = True, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Sampled records with enriched text, and the macro display table.

    ``chosen`` names the clusters, one row each; ``limit`` is the size of the sample.
    """
    # Every macro has a name, so no text is ever empty: the sample can be drawn
    # from the ids alone, and titles and abstracts are fetched for it only.
    docs = restrict(articles, chosen, "micro_cluster").where(F.col("macro_cluster").isNotNull())
    ids = scratch.save(docs.select("id", "macro_cluster"))
    display = scratch.save(macro_display(ids, names, colors, macro_report, scratch))
    sampled = scratch.save(stratified_sample(ids, "macro_cluster", "id", limit, seed, scratch))
    fetched = backfill(restrict(docs, sampled, "id"), [restrict(t, sampled, "id") for t in fallbacks])
    body = F.col("abstract") if with_abstract else None
    told = fetched.withColumnRenamed("id", "paper_id") \
        .join(display.select("macro_cluster", "display_id", "macro_name", "color_hex"), "macro_cluster") \
        .withColumn("text_enriched", text.enriched_text(F.col("macro_name"), F.col("title"), body))
    return told.select(*RECORD_COLUMNS).orderBy("display_id", "macro_cluster", "paper_id"), display


def keyword_texts(works: DataFrame, meso_keywords: DataFrame, macro_keywords: DataFrame,
                  times: int = 2) -> DataFrame:
    """Titles weighted up with their parents' keywords."""
    meso = meso_keywords.select(F.col("cluster").alias("meso_cluster"), F.col("keywords").alias("_meso"))
    macro = macro_keywords.select(F.col("cluster").alias("macro_cluster"), F.col("keywords").alias("_macro"))
    told = lookup(lookup(works, meso, "meso_cluster", "left"), macro, "macro_cluster", "left")
    return told.select(
        "id", text.keyword_boosted_text(F.col("title"), F.col("_meso"), F.col("_macro"), times).alias("text"))


def prefixed_texts(labels: DataFrame, texts: DataFrame, names: DataFrame, child_names: DataFrame) -> DataFrame:
    """'parent. child. title abstract' for documents whose child cluster has a name."""
    parents = names.select(F.col("code").alias("parent_code"), F.col("name").alias("_parent"))
    kids = child_names.select(F.col("code").alias("child_code"), F.col("name").alias("_child"))
    return labels.join(texts, "id").join(kids, "child_code").join(parents, "parent_code", "left") \
        .select("id", text.prefixed_text(F.col("_parent"), F.col("_child"), F.col("title"),
                                         F.col("abstract")).alias("text"))
