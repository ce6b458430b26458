"""Inputs and outputs of cluster naming: contexts, requests, answers, final names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldatlas.functions import text
from fieldatlas.functions.colors import stable_color
from fieldatlas.operators.joins import lookup
from fieldatlas.operators.ranking import first_per_key, top_n, with_position
from fieldatlas.session import Scratch

ANSWER = "name string, short_name string, description string"


def macro_colors(report: DataFrame) -> DataFrame:
    """One stable colour per macro cluster."""
    ids = report.where(F.col("macro_cluster").isNotNull()) \
                .select(F.col("macro_cluster").cast("bigint").alias("macro_cluster")).distinct()
    return ids.withColumn("color_hex", stable_color(F.col("macro_cluster")))


def _ordered_list(ranked: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Collect at most top-n ranked rows of each key into an ordered list."""
    return ranked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", value))).alias("_l")) \
                 .select(key, F.col(f"_l.{value}").alias(name))


def _one_each(keywords: DataFrame, key: str) -> DataFrame:
    """One keyword list per cluster, the first in text order."""
    return keywords.groupBy(F.col("cluster").alias(key)).agg(F.min("keywords").alias("keywords"))


def top_titles(articles: DataFrame, key: str = "macro_cluster", n: int = 50) -> DataFrame:
    """Most cited non-empty titles of each cluster as an ordered list."""
    titled = articles.select(key, F.trim("title").alias("title"), F.col("citations").cast("bigint").alias("citations")) \
                     .where(F.col(key).isNotNull() & (F.col("title") != ""))
    best = top_n(titled, [key], [F.col("citations").desc_nulls_last(), F.col("title").asc()], n, "rank")
    return _ordered_list(best, key, "title", "titles")


def child_context(report: DataFrame, keywords: DataFrame, parent: str = "macro_cluster",
                  child: str = "meso_cluster", n: int = 4) -> DataFrame:
    """Keywords of the largest children of each parent, joined by ' | '."""
    rows = report.select(parent, child, F.coalesce(F.col("publications"), F.lit(0)).alias("publications")) \
                 .join(_one_each(keywords, child), child, "left")
    best = top_n(rows, [parent], [F.col("publications").desc(), F.col(child).asc()], n, "rank")
    kept = best.where(F.trim("keywords") != "").withColumn("keywords", F.trim("keywords"))
    return _ordered_list(kept, parent, "keywords", "parts") \
        .select(parent, F.array_join("parts", " | ").alias("context"))


def macro_inputs(macro_report: DataFrame, macro_keywords: DataFrame, context: DataFrame) -> DataFrame:
    """One naming row per macro cluster: size, keywords and children's keywords."""
    base = macro_report.groupBy("macro_cluster").agg(F.max("publications").alias("publications"))
    return base.join(_one_each(macro_keywords, "macro_cluster"), "macro_cluster", "left") \
               .join(context, "macro_cluster", "left") \
               .select("macro_cluster", "publications",
                       F.coalesce("keywords", F.lit("")).alias("macro_keywords"),
                       F.coalesce("context", F.lit("")).alias("meso_context"))


def micro_inputs(micro_report: DataFrame, keywords: DataFrame, articles: DataFrame, n: int = 10) -> DataFrame:
    """One naming row per micro cluster: keywords and an ordered title list."""
    best = top_n(articles.where(F.col("title").isNotNull()), ["micro_cluster"],
                 [F.col("citations").desc_nulls_last(), F.col("id").asc()], n, "rank")
    titles = _ordered_list(best, "micro_cluster", "title", "titles")
    return micro_report.select("micro_cluster") \
        .join(_one_each(keywords, "micro_cluster"), "micro_cluster", "left") \
        .join(titles, "micro_cluster", "left") \
        .select("micro_cluster", F.coalesce("keywords", F.lit("")).alias("keywords"),
                F.coalesce("titles", F.array().cast("array<string>")).alias("titles"))


def prompt(keywords: Column, titles: Column) -> Column:
    """Keywords and numbered titles of one cluster as text."""
    numbered = F.transform(titles, lambda t, at: F.concat((at + 1).cast("string"), F.lit(". "), t))
    return F.concat(F.lit("Terms that set this cluster apart:\n"), F.trim(keywords),
                    F.lit("\n\nIts most cited works:\n"), F.array_join(numbered, "\n"))


def request_rows(inputs: DataFrame) -> DataFrame:
    """Request id and prompt per micro cluster."""
    return inputs.select(F.concat(F.lit("micro-"), F.col("micro_cluster").cast("string")).alias("custom_id"),
                         prompt(F.col("keywords"), F.col("titles")).alias("prompt"))


def batches(inputs: DataFrame, key: str, scratch: Scratch, size: int = 8) -> DataFrame:
    """Number the rows in id order and cut them into batches of fixed size."""
    placed = with_position(inputs, [F.col(key).asc()], "_pos", scratch)
    return placed.withColumn("batch", F.floor(F.col("_pos") / size)).drop("_pos")


def macro_requests(inputs: DataFrame, scratch: Scratch, size: int = 8) -> DataFrame:
    """One request per batch of macro clusters: their naming rows as a JSON list.

    A list holds at most ``size`` rows.
    """
    fields = [c for c in inputs.columns if c != "macro_cluster"]
    rows = batches(inputs, "macro_cluster", scratch, size)
    listed = rows.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("macro_cluster", *fields))).alias("items"))
    return listed.select("batch", F.to_json("items").alias("clusters"))


def parse_answers(answers: DataFrame) -> DataFrame:
    """Columns of JSON answers, or an error marker; input ``custom_id, content, refusal``."""
    parsed = answers.withColumn("p", F.from_json("content", ANSWER))
    complete = (F.col("p.name").isNotNull() & F.col("p.short_name").isNotNull()
                & F.col("p.description").isNotNull() & F.col("refusal").isNull())
    error = F.when(F.col("refusal").isNotNull(), F.concat(F.lit("refusal: "), F.col("refusal"))) \
             .when(~complete, F.lit("parse: no complete answer"))
    return parsed.select(
        F.get(F.split("custom_id", "-"), F.lit(1)).try_cast("bigint").alias("micro_cluster"),
        *[F.when(complete, F.col(f"p.{c}")).alias(c) for c in ("name", "short_name", "description")],
        error.alias("error"))


def coverage(expected: DataFrame, found: DataFrame, key: str = "macro_cluster") -> DataFrame:
    """Ids that are missing and ids nobody asked for, as (id, status) rows."""
    missing = expected.select(key).distinct().join(found, key, "left_anti").withColumn("status", F.lit("missing"))
    extra = found.select(key).distinct().join(expected, key, "left_anti").withColumn("status", F.lit("unexpected"))
    return missing.unionByName(extra)


def unique_names(names: DataFrame, scratch: Scratch, key: str = "macro_cluster",
                 exact: bool = False) -> DataFrame:
    """Append ' (id)' to repeated names.

    With ``exact`` every copy of a repeated name is marked.  Otherwise case is
    ignored and only later ids are marked, including a name that equals one
    already made by marking an earlier id.
    """
    marked = F.concat(F.col("name"), F.lit(" ("), F.col(key).cast("string"), F.lit(")"))
    if exact:
        counts = names.groupBy("name").agg(F.count(F.lit(1)).alias("_n"))
        return lookup(names, counts, "name").withColumn("name", F.when(F.col("_n") > 1, marked)
                                                     .otherwise(F.col("name"))).drop("_n")
    first = names.groupBy(F.lower("name").alias("_lower")).agg(F.min(key).alias("_first"))
    tagged = lookup(names.withColumn("_lower", F.lower("name")), first, "_lower")
    state = scratch.save(tagged.withColumn("_mark", F.col(key) != F.col("_first")).drop("_first"))
    while True:
        made = state.where("_mark").select(F.lower(marked).alias("_lower"), F.col(key).alias("_by")) \
                    .groupBy("_lower").agg(F.min("_by").alias("_by"))
        clash = scratch.save(state.where("not _mark").join(made, "_lower")
                             .where(F.col("_by") < F.col(key)).select(key, F.lit(True).alias("_clash")))
        if clash.isEmpty():
            break
        previous = state
        state = scratch.save(state.join(clash, key, "left")
                             .withColumn("_mark", F.col("_mark") | F.coalesce("_clash", F.lit(False))).drop("_clash"))
        scratch.drop(previous)
    return state.withColumn("name", F.when(F.col("_mark"), marked).otherwise(F.col("name"))).drop("_mark", "_lower")


def final_names(raw: DataFrame, expected: DataFrame, titles: DataFrame, scratch: Scratch) -> DataFrame:
    """Name and description of every expected macro cluster.

    Unexpected ids go, the first answer per id stays, gaps are filled from the
    titles and names are made unique.
    """
    named = first_per_key(raw, ["macro_cluster"], [F.col("position").asc()])
    rows = expected.select("macro_cluster").distinct().join(named, "macro_cluster", "left") \
                   .join(titles, "macro_cluster", "left")
    cluster, listed = F.col("macro_cluster"), F.col("titles")
    filled = rows.select(
        "macro_cluster",
        F.coalesce(text.blank_to_null(F.col("name")), text.fallback_name(cluster, listed)).alias("name"),
        F.coalesce(text.blank_to_null(F.col("description")),
                   text.fallback_description(cluster, listed)).alias("description"))
    return unique_names(filled, scratch)


def names_from_keywords(raw: DataFrame, expected: DataFrame, keywords: DataFrame, scratch: Scratch) -> DataFrame:
    """Name of every expected macro cluster; gaps take the first keyword."""
    named = first_per_key(raw, ["macro_cluster"], [F.col("position").asc()])
    rows = expected.select("macro_cluster").distinct().join(named, "macro_cluster", "left") \
                   .join(keywords.withColumnRenamed("cluster", "macro_cluster"), "macro_cluster", "left")
    first = text.title_case(F.trim(F.substring_index(F.coalesce("keywords", F.lit("")), ",", 1)))
    fallback = F.coalesce(text.blank_to_null(first),
                          F.concat(F.lit("Macro Field "), F.col("macro_cluster").cast("string")))
    return unique_names(rows.select("macro_cluster", F.coalesce("name", fallback).alias("name")), scratch, exact=True)
