"""Report focused on one institution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldatlas.functions.numbers import ratio, round_even, round_to
from fieldatlas.operators.ranking import top_n
from fieldatlas.operators.selection import restrict, with_display_ids
from fieldatlas.session import Scratch


def papers_of(articles: DataFrame, institution: str, *columns: str) -> DataFrame:
    """Distinct works that list the institution."""
    return articles.where(F.array_contains("institutions", institution)).select(*columns).distinct()


def own_stats(articles: DataFrame, institution: str) -> DataFrame:
    """The institution's works per micro cluster with their averages."""
    return (
        papers_of(articles, institution, "id", "micro_cluster", "publication_year", "citations")
        .groupBy("micro_cluster").agg(
            F.count(F.lit(1)).alias("publications_own"),
            round_to(F.avg(F.col("publication_year").try_cast("double")), 1).alias("ave_py_own"),
            round_to(F.avg("citations"), 2).alias("ave_citations_own")))


def cluster_summary(micro_report: DataFrame, articles: DataFrame, institution: str,
                    scratch: Scratch) -> DataFrame:
    """Clusters with works of the institution: its share and averages beside the totals."""
    base = with_display_ids(micro_report, "micro_cluster", scratch, "yearly_rank_citations").select(
        "display_id", F.col("micro_cluster").alias("global_id"), "micro_cluster", "meso_cluster",
        "macro_cluster", F.col("publications").alias("publications_total"),
        F.col("ave_py").alias("ave_py_total"), F.col("ave_citations").alias("ave_citations_total"))
    own = own_stats(restrict(articles, micro_report, "micro_cluster"), institution)
    share = F.coalesce(ratio(F.col("publications_own"), F.col("publications_total")), F.lit(0.0))
    return base.join(own, "micro_cluster").withColumn("pct_own", round_even(share, 4)) \
               .orderBy(F.col("publications_own").desc(), "display_id")


def top_works(summary: DataFrame, articles: DataFrame, institution: str, n: int = 10) -> DataFrame:
    """The institution's most cited works in each of its clusters."""
    columns = ["id", "title", "publication_year", "citations", "micro_cluster", "meso_cluster", "macro_cluster"]
    papers = restrict(papers_of(articles, institution, *columns), summary, "micro_cluster")
    best = top_n(papers, ["micro_cluster"], [F.col("citations").desc_nulls_last(), F.col("id").asc()], n)
    return best.join(summary.select("micro_cluster", "display_id", "global_id"), "micro_cluster") \
               .withColumn("institution", F.lit(institution)) \
               .orderBy("display_id", F.col("citations").desc_nulls_last(), "id")
