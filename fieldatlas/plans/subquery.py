"""Subqueries: pick micro clusters, then cut every report table down to them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldatlas.operators import selection
from fieldatlas.operators.reports import entity_stats, top_articles
from fieldatlas.session import Scratch
from fieldatlas.sources.writers import write_table

SUBSETS = ("matches", "article_top10", "cluster_report_micro", "cluster_report_meso",
           "cluster_report_macro", "top_countries", "top_institutions")
ARTICLE_COLUMNS = ("id", "title", "citations", "countries", "institutions", "micro_cluster",
                   "meso_cluster", "macro_cluster", "publication_year")


def by_topic(reports: dict[str, DataFrame], centroids: DataFrame, query: Iterable[float],
             scratch: Scratch, threshold: float = 0.50, min_size: int = 30) -> tuple[DataFrame, DataFrame]:
    """Clusters near a query vector: (selected micro report, matches by similarity)."""
    near = selection.cosine_scores(centroids, query).where(F.col("similarity") >= threshold)
    micro = selection.at_least(selection.restrict(reports["micro"], near, "micro_cluster"), min_size)
    chosen = scratch.save(selection.with_cluster_codes(scratch.save(micro), scratch))
    matches = near.join(chosen.select("micro_cluster", "publications"), "micro_cluster")
    return chosen, matches.orderBy(F.col("similarity").desc(), "micro_cluster")


def by_filters(reports: dict[str, DataFrame], rules: Sequence[str], scratch: Scratch,
               min_size: int = 50) -> tuple[DataFrame, DataFrame]:
    """Clusters that satisfy all numeric rules: (selected micro report, matches)."""
    parsed = [selection.parse_rule(rule) for rule in rules]
    micro = selection.at_least(selection.apply_rules(reports["micro"], parsed), min_size)
    chosen = scratch.save(selection.with_cluster_codes(scratch.save(micro), scratch))
    columns = ["micro_cluster", "publications", "meso_cluster", "macro_cluster"]
    columns += [r.column for r in dict.fromkeys(parsed) if r.column not in columns]
    order = [F.col(c).desc_nulls_last() for c in dict.fromkeys(r.column for r in parsed)]
    matches = chosen.select(*dict.fromkeys(columns), F.lit(" AND ".join(rules)).alias("filters_applied"))
    return chosen, matches.orderBy(*order, "micro_cluster")


def everything(reports: dict[str, DataFrame], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """All clusters: (micro report with codes, matches)."""
    chosen = scratch.save(selection.with_cluster_codes(scratch.save(reports["micro"]), scratch))
    matches = chosen.select("micro_cluster", "publications", "meso_cluster", "macro_cluster",
                            F.lit("passthrough_all").alias("filters_applied"))
    return chosen, matches.orderBy("micro_cluster")


def subsets(chosen: DataFrame, matches: DataFrame, reports: dict[str, DataFrame], articles: DataFrame,
            papers: int = 10, entities: int = 20) -> dict[str, DataFrame]:
    """The seven tables of a subquery; the selection stays a table throughout."""
    inside = selection.restrict(articles, chosen, "micro_cluster")
    return {
        "matches": matches,
        "article_top10": top_articles(inside, "micro_cluster", papers).select(*ARTICLE_COLUMNS),
        "cluster_report_micro": chosen,
        "cluster_report_meso": selection.restrict(reports["meso"], chosen, "meso_cluster"),
        "cluster_report_macro": selection.restrict(reports["macro"], chosen, "macro_cluster"),
        "top_countries": entity_stats(inside, "micro_cluster", "countries", "country", entities),
        "top_institutions": entity_stats(inside, "micro_cluster", "institutions", "institution", entities),
    }


def export(tables: dict[str, DataFrame], target: str) -> dict[str, int]:
    """Write every subset and return the row counts."""
    return {name: write_table(df, f"{target}/{name}") for name, df in tables.items()}


# --- lookups over a written subquery ----------------------------------------

def summary(micro: DataFrame, meso: DataFrame, macro: DataFrame) -> DataFrame:
    """Clusters per level and papers in total, as one row."""
    one = F.lit(1).alias("_one")
    parts = [micro.agg(F.count(F.lit(1)).alias("micro_clusters"),
                       F.coalesce(F.sum("publications"), F.lit(0)).alias("papers")),
             meso.agg(F.count(F.lit(1)).alias("meso_clusters")),
             macro.agg(F.count(F.lit(1)).alias("macro_clusters"))]
    first, second, third = [part.select("*", one) for part in parts]
    return first.join(second, "_one").join(third, "_one").drop("_one")


def overview(micro: DataFrame, matches: DataFrame | None = None) -> DataFrame:
    """Cluster rows by similarity when there is one, else by size."""
    rows = micro.select("micro_cluster", "meso_cluster", "macro_cluster", "publications",
                        "ave_citations", "yearly_rank_citations", "recency_py")
    if matches is None or "similarity" not in matches.columns:
        return rows.orderBy(F.col("publications").desc(), "micro_cluster")
    return rows.join(matches.select("micro_cluster", "similarity"), "micro_cluster", "left") \
               .orderBy(F.col("similarity").desc_nulls_last(), "micro_cluster")


def profile(tables: dict[str, DataFrame], cluster: int) -> dict[str, DataFrame]:
    """Report row, titles and leading entities of one micro cluster."""
    mine = {name: tables[name].where(F.col("micro_cluster") == cluster) for name in
            ("cluster_report_micro", "article_top10", "top_countries", "top_institutions")}
    by_count = [F.col("freq").desc()]
    return {
        "report": mine["cluster_report_micro"],
        "titles": mine["article_top10"].select("citations", "publication_year", "title")
                                       .orderBy(F.col("citations").desc_nulls_last(), "title"),
        "countries": mine["top_countries"].orderBy(*by_count, "country").limit(10),
        "institutions": mine["top_institutions"].orderBy(*by_count, "institution").limit(10)}


def children(micro: DataFrame, level: str, cluster: int) -> DataFrame:
    """Matched micro clusters of one meso or macro cluster, as rows."""
    return micro.where(F.col(f"{level}_cluster") == cluster).select("micro_cluster", "publications")
