"""Raw works to node and citation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas.functions import text
from fieldatlas.sources.readers import dated_path, read_works, snapshot_date
from fieldatlas.sources.writers import write_table


def nodes(works: DataFrame, prefix: str) -> DataFrame:
    """One flat row per work.  Author lists are built inside the row, without a shuffle."""
    people = F.col("authorships")
    return works.select(
        text.strip_prefix(F.col("id"), prefix).alias("id"), "doi", "title",
        text.abstract_text(F.col("abstract_inverted_index")).alias("abstract"), "language",
        F.col("type").alias("type_openalex"), "type_crossref",
        F.col("cited_by_count").alias("citations"),
        F.col("primary_location.source.display_name").alias("publication_source"),
        text.distinct_across(people, "country_code").alias("countries"),
        text.distinct_across(people, "display_name").alias("institutions"),
        text.distinct_across(people, "ror").alias("institutions_ror"),
        text.distinct_across(people, "type").alias("institutions_type"),
        text.author_names(people).alias("authors"), "publication_year")


def edges(works: DataFrame, prefix: str) -> DataFrame:
    """Distinct citations; self-citations and mutual citations stay."""
    return (
        works.select(text.strip_prefix(F.col("id"), prefix).alias("from"),
                     F.explode("referenced_works").alias("_to"))
        .select("from", text.strip_prefix(F.col("_to"), prefix).alias("to"),
                F.lit(1).alias("weight"))
        .where(F.col("from").isNotNull() & F.col("to").isNotNull() & (F.col("to") != ""))
        .distinct())


def ingest(spark: SparkSession, source: str, target: str, prefix: str,
           manifest: str | None = None, mode: str = "overwrite") -> dict[str, int]:
    """Write nodes_snapshot, by year, and edges_snapshot; returns their row counts.

    Each table is written from its own narrow scan: the node scan never reads
    the references and the edge scan parses nothing but ids, which costs less
    than keeping the parsed corpus.
    """
    if manifest:
        target = dated_path(target, snapshot_date(spark, manifest))
    works = read_works(spark, source)
    return {
        "nodes": write_table(nodes(works, prefix), f"{target}/nodes_snapshot", mode,
                             partition_by=["publication_year"]),
        "edges": write_table(edges(works, prefix), f"{target}/edges_snapshot", mode)}
