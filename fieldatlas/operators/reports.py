"""Cluster reports, entity statistics, audits and size tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldatlas.functions.numbers import ratio, round_even, round_to
from fieldatlas.operators.ranking import percent_rank_table, top_n
from fieldatlas.session import Scratch

LEVELS = ("micro", "meso", "macro")
CLUSTER_COLUMNS = tuple(f"{level}_cluster" for level in LEVELS)


def cluster_column(level: str) -> str:
    if level not in LEVELS:
        raise ValueError(f"unknown level {level!r}; use one of {', '.join(LEVELS)}")
    return f"{level}_cluster"


def article_report(nodes: DataFrame, index: DataFrame, clusters: DataFrame) -> DataFrame:
    """Works with their cluster ids: assignment -> dense index -> node table."""
    return (
        clusters.join(index.withColumnRenamed("id", "node_id"), "node_id")
        .withColumnRenamed("node_str", "id")
        .join(nodes, "id")
        .select("id", "title", "abstract", "citations", "countries", "institutions",
                *CLUSTER_COLUMNS, "publication_year")
    )


def discrete_medians(folded: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Lower median per key of each value column, from rows with a count ``n``.

    All columns go through one pass, which works on one row per distinct value
    and never on the rows of a group.
    """
    entries = F.explode(F.array(*[
        F.struct(F.lit(v).alias("metric"), F.col(v).cast("bigint").alias("value")) for v in values]))
    counts = folded.select(key, "n", entries.alias("e")).where("e.value is not null") \
                   .groupBy(key, "e.metric", "e.value").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(key, "metric")
    running = F.sum("n").over(group.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    reached = counts.select(key, "metric", "value", (running * 2 >= F.sum("n").over(group)).alias("_reached")) \
                    .where("_reached")
    return reached.groupBy(key).agg(*[
        F.min(F.when(F.col("metric") == v, F.col("value"))).alias(f"median_{v}") for v in values])


def fold_articles(articles: DataFrame, country: str = "JP", scratch: Scratch | None = None) -> DataFrame:
    """Works folded to one counted row per (cluster ids, year, citations).

    This is the only pass over the corpus.  It shuffles partial counts and is
    kept as a scratch table, from which the reports of all levels are computed.
    """
    scratch = scratch or Scratch(articles.sparkSession)
    works = articles.select(*[F.col(c).cast("bigint").alias(c) for c in CLUSTER_COLUMNS],
                            "publication_year", F.col("citations").cast("bigint").alias("citations"),
                            F.array_contains("countries", country).alias("_home"))
    folded = works.groupBy(*CLUSTER_COLUMNS, "publication_year", "citations").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_home").alias("home"))
    return scratch.save(folded.withColumn("py", F.col("publication_year").try_cast("int")))


def report_from_fold(fold: DataFrame, level: str, since: int = 2024) -> DataFrame:
    """Size, citation, rank-within-year and year metrics of each cluster of a level."""
    key, depth = cluster_column(level), LEVELS.index(level)
    children = CLUSTER_COLUMNS[:depth][::-1]
    parents = CLUSTER_COLUMNS[depth + 1:]
    fold = fold.where(F.col(key).isNotNull())
    ranks = percent_rank_table(fold, "publication_year", "citations", F.col("n")).alias("r")
    ranked = fold.alias("f").join(
        ranks,
        F.col("f.publication_year").eqNullSafe(F.col("r.publication_year"))
        & F.col("f.citations").eqNullSafe(F.col("r.citations")),
    ).select("f.*", "r.paper_rank")

    def mean(value: Column) -> Column:
        known = F.sum(F.when(value.isNotNull(), F.col("n")))
        return ratio(F.sum(value * F.col("n")), known)

    cites, py, n = F.col("citations"), F.col("py"), F.col("n")
    report = ranked.groupBy(key).agg(
        *[F.min(p).alias(p) for p in parents],
        F.sum(n).alias("publications"),
        F.min(cites).alias("min_citations"),
        round_to(mean(cites), 2).alias("ave_citations"),
        F.max(cites).alias("max_citations"),
        round_to(mean(F.col("paper_rank")), 4).alias("yearly_rank_citations"),
        F.min(py).cast("bigint").alias("min_py"),
        round_to(mean(py), 1).alias("ave_py"),
        F.max(py).cast("bigint").alias("max_py"),
        round_to(ratio(F.sum(F.when(py >= since, n).otherwise(0)), F.sum(n)), 4).alias("recency_py"),
        F.sum("home").alias("japan_count"),
    )
    report = report.join(discrete_medians(fold, key, ["citations", "py"]), key, "left")
    if children:
        report = report.join(fold.groupBy(key).agg(*[
            F.countDistinct(c).alias(c.replace("_cluster", "_clusters")) for c in children]), key)
    return report.select(
        key, *parents, *[c.replace("_cluster", "_clusters") for c in children],
        "publications", "min_citations", "ave_citations", "median_citations", "max_citations",
        "yearly_rank_citations", "min_py", "ave_py", "median_py", "max_py", "recency_py", "japan_count")


def cluster_report(articles: DataFrame, level: str, country: str = "JP", since: int = 2024) -> DataFrame:
    """Report of one level."""
    return report_from_fold(fold_articles(articles, country), level, since)


def cluster_reports(articles: DataFrame, country: str = "JP", since: int = 2024) -> dict[str, DataFrame]:
    """Reports of every level from one pass over the corpus."""
    fold = fold_articles(articles, country)
    return {level: report_from_fold(fold, level, since) for level in LEVELS}


def child_counts(df: DataFrame, parent: str, child: str) -> DataFrame:
    """Distinct children of every parent."""
    return (df.where(F.col(child).isNotNull()).select(parent, child).distinct()
            .groupBy(parent).agg(F.count(F.lit(1)).alias(child.replace("_cluster", "_clusters"))))


def by_size(report: DataFrame) -> DataFrame:
    """Largest clusters first."""
    return report.orderBy(F.col("publications").desc(), F.col(report.columns[0]))


def entity_stats(articles: DataFrame, key: str, values: str, name: str, top: int | None = None) -> DataFrame:
    """How often each entity of an array column occurs per cluster, with its averages.

    Null and empty arrays vanish; a null entity inside an array is kept.
    """
    stats = (
        articles.select(key, F.explode(values).alias(name),
                        F.col("publication_year").try_cast("double").alias("_year"), "citations")
        .groupBy(key, name)
        .agg(F.count(F.lit(1)).alias("freq"),
             round_to(F.avg("_year"), 1).alias("avg_publication_year"),
             round_to(F.avg("citations"), 2).alias("avg_citation"))
    )
    if top is None:
        return stats
    return top_n(stats, [key], [F.col("freq").desc(), F.col(name).asc_nulls_last()], top)


def top_articles(articles: DataFrame, key: str, n: int) -> DataFrame:
    """Most cited works of each cluster, ties by id."""
    return top_n(articles.where(F.col(key).isNotNull()), [key],
                 [F.col("citations").desc_nulls_last(), F.col("id").asc()], n)


# --- audits ----------------------------------------------------------------

def _count_null(column: str, name: str) -> Column:
    return F.count_if(F.col(column).isNull()).alias(name)


def coverage_audit(articles: DataFrame) -> DataFrame:
    """Works without a cluster id, level by level."""
    micro, meso, macro = (F.col(c) for c in CLUSTER_COLUMNS)
    return articles.agg(
        F.count(F.lit(1)).alias("docs_total"),
        _count_null("micro_cluster", "docs_null_micro"),
        _count_null("meso_cluster", "docs_null_meso"),
        _count_null("macro_cluster", "docs_null_macro"),
        F.count_if(micro.isNotNull() & meso.isNull()).alias("docs_micro_without_meso"),
        F.count_if(micro.isNotNull() & macro.isNull()).alias("docs_micro_without_macro"))


def parent_profile(articles: DataFrame, level: str) -> DataFrame:
    """Per cluster: works, distinct parents and works without a parent."""
    key = cluster_column(level)
    parents = [p for p in LEVELS[LEVELS.index(level) + 1:]]
    return articles.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("docs"),
        *[F.countDistinct(f"{p}_cluster").alias(f"{p}_distinct_nonnull") for p in parents],
        *[_count_null(f"{p}_cluster", f"docs_null_{p}") for p in parents])


def consistency_audit(articles: DataFrame, level: str) -> DataFrame:
    """How many clusters of a level lack a parent or have several."""
    parents = LEVELS[LEVELS.index(level) + 1:]
    found = parent_profile(articles, level)
    checks = [F.count(F.lit(1)).alias(f"{level}_total")]
    for p in parents:
        distinct = F.col(f"{p}_distinct_nonnull")
        checks += [
            F.count_if(F.col(f"docs_null_{p}") > 0).alias(f"{level}_with_any_null_{p}"),
            F.count_if(distinct == 0).alias(f"{level}_without_any_{p}"),
            F.count_if(distinct > 1).alias(f"{level}_with_multiple_{p}")]
    return found.agg(*checks)


def inconsistent_clusters(articles: DataFrame, level: str, limit: int = 20) -> DataFrame:
    """The largest clusters whose parents are missing or contradictory."""
    parents = LEVELS[LEVELS.index(level) + 1:]
    faults = [(F.col(f"docs_null_{p}") > 0) | (F.col(f"{p}_distinct_nonnull") > 1) for p in parents]
    return (parent_profile(articles, level).where(reduce(lambda a, b: a | b, faults))
            .orderBy(F.col("docs").desc(), cluster_column(level)).limit(limit))


def hierarchy_summary(clusters: DataFrame) -> DataFrame:
    """One row of counters over a node-to-cluster assignment."""
    totals = clusters.agg(
        F.count(F.lit(1)).alias("docs_total"),
        _count_null("meso_cluster", "null_meso_docs"),
        _count_null("macro_cluster", "null_macro_docs"))
    micro = parent_profile(clusters, "micro").agg(
        F.count(F.lit(1)).alias("micro_clusters"),
        F.count_if(F.col("meso_distinct_nonnull") == 0).alias("micro_without_meso"),
        F.count_if(F.col("macro_distinct_nonnull") == 0).alias("micro_without_macro"),
        F.count_if(F.col("meso_distinct_nonnull") > 1).alias("micro_with_multiple_meso"),
        F.count_if(F.col("macro_distinct_nonnull") > 1).alias("micro_with_multiple_macro"))
    meso = parent_profile(clusters, "meso").agg(
        F.count(F.lit(1)).alias("meso_clusters"),
        F.count_if(F.col("macro_distinct_nonnull") == 0).alias("meso_without_macro"),
        F.count_if(F.col("macro_distinct_nonnull") > 1).alias("meso_with_multiple_macro"))
    macro = clusters.agg(F.countDistinct("macro_cluster").alias("macro_clusters"))
    one = F.lit(1).alias("_one")
    parts = [part.select("*", one) for part in (totals, micro, meso, macro)]
    # each part is a single aggregate row
    return reduce(lambda a, b: a.join(b, "_one"), parts).select(
        "docs_total", "null_meso_docs", "null_macro_docs",
        "micro_clusters", "meso_clusters", "macro_clusters",
        "micro_without_meso", "micro_without_macro", "micro_with_multiple_meso",
        "micro_with_multiple_macro", "meso_without_macro", "meso_with_multiple_macro")


# --- sizes -----------------------------------------------------------------

def level_counts(clusters: DataFrame) -> DataFrame:
    """Rows and distinct clusters of each level."""
    return clusters.agg(F.count(F.lit(1)).alias("rows_total"),
                        *[F.countDistinct(f"{level}_cluster").alias(f"distinct_{level}")
                          for level in LEVELS])


def cluster_sizes(clusters: DataFrame, key: str) -> DataFrame:
    return clusters.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("members"))


def extreme_sizes(sizes: DataFrame, key: str, n: int = 20, largest: bool = True) -> DataFrame:
    """The n largest, or smallest, clusters."""
    order = F.col("members").desc() if largest else F.col("members").asc()
    return sizes.orderBy(order, key).limit(n)


def size_coverage(sizes: DataFrame, at_least: int = 50) -> DataFrame:
    """How many clusters reach a size and what share of all members they hold."""
    big = F.col("members") >= at_least
    held = F.sum(F.when(big, F.col("members")).otherwise(0))
    return sizes.agg(
        F.count(F.lit(1)).alias("clusters"), F.count_if(big).alias("clusters_at_least"),
        round_to(100.0 * F.count_if(big) / F.count(F.lit(1)), 2).alias("pct_clusters"),
        round_to(100.0 * held / F.sum("members"), 2).alias("pct_members"))


def threshold_stats(report: DataFrame, level: str, thresholds: Sequence[int]) -> DataFrame:
    """Clusters above each size threshold."""
    size = F.coalesce(F.col("publications").try_cast("double"), F.lit(0.0))
    counts = report.agg(F.count(F.lit(1)).alias("total_clusters"),
                        *[F.count_if(size > t).alias(f"t{i}") for i, t in enumerate(thresholds)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(t).cast("bigint").alias("threshold"), F.col(f"t{i}").alias("above"))
        for i, t in enumerate(thresholds)]))
    share = F.coalesce(ratio(100.0 * F.col("r.above"), F.col("total_clusters")), F.lit(0.0))
    return counts.select("total_clusters", rows.alias("r")).select(
        F.lit(level).alias("level"), F.col("r.threshold").alias("threshold"),
        F.col("r.above").alias("clusters_above_threshold"),
        round_even(share, 2).alias("pct_clusters_above_threshold"), "total_clusters")


def overview(reports: dict[str, DataFrame]) -> DataFrame:
    """Papers and number of clusters per level as metric rows."""
    rows = [reports["micro"].agg(F.lit("papers").alias("metric"),
                                 F.coalesce(F.sum("publications"), F.lit(0)).alias("value"))]
    rows += [reports[level].agg(F.lit(f"{level}_clusters").alias("metric"),
                                F.count(F.lit(1)).alias("value")) for level in LEVELS]
    return reduce(DataFrame.unionByName, rows)


def largest_macro(micro_report: DataFrame) -> DataFrame:
    """The macro cluster that holds most micro clusters."""
    return (micro_report.groupBy("macro_cluster").agg(F.count(F.lit(1)).alias("micro_clusters"))
            .orderBy(F.col("micro_clusters").desc(), "macro_cluster").limit(1))
