"""Cluster reports, audits and size tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas import derive
from fieldatlas.catalog import fragments as q
from fieldatlas.functions.text import joined_names
from fieldatlas.operators import reports
from fieldatlas.plans import migrate

THRESHOLDS = (5, 10, 15, 20)


def report(spark: SparkSession, folder: str, level: str) -> DataFrame:
    return report_of(derive.works(spark, folder), level)


def report_of(works: DataFrame, level: str) -> DataFrame:
    return reports.cluster_report(works, level, country=derive.HOME_COUNTRY, since=derive.RECENT_YEAR)


def flat_lists(articles: DataFrame) -> DataFrame:
    """Array cells as text, so that both engines print them alike."""
    return articles.withColumns({c: joined_names(F.col(c), "|") for c in ("countries", "institutions")})


def _article_report(spark: SparkSession, folder: str) -> DataFrame:
    works = derive.works(spark, folder)
    nodes = works.drop("micro_cluster", "meso_cluster", "macro_cluster")
    number = F.substring("id", 2, 20).cast("bigint")
    index = works.select(number.alias("id"), F.col("id").alias("node_str"))
    clusters = works.select(number.alias("node_id"), "micro_cluster", "meso_cluster", "macro_cluster")
    return flat_lists(reports.article_report(nodes, index, clusters))


def _size_distribution(spark: SparkSession, folder: str) -> DataFrame:
    sizes = reports.cluster_sizes(derive.works(spark, folder), "micro_cluster")
    top = reports.extreme_sizes(sizes, "micro_cluster", 20, largest=True)
    low = reports.extreme_sizes(sizes, "micro_cluster", 20, largest=False)
    return top.withColumn("side", F.lit("largest")).unionByName(low.withColumn("side", F.lit("smallest")))


def all_reports(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return reports.cluster_reports(derive.works(spark, folder), country=derive.HOME_COUNTRY,
                                   since=derive.RECENT_YEAR)


def _threshold_stats(spark: SparkSession, folder: str) -> DataFrame:
    found = all_reports(spark, folder)
    parts = [reports.threshold_stats(found[level], level, THRESHOLDS) for level in reports.LEVELS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


QUERIES = {
    "article_report": _article_report,
    "cluster_report_micro": lambda s, d: report(s, d, "micro"),
    "cluster_report_meso": lambda s, d: report(s, d, "meso"),
    "cluster_report_macro": lambda s, d: report(s, d, "macro"),
    "audit_coverage": lambda s, d: reports.coverage_audit(derive.faulty_works(s, d)),
    "audit_micro": lambda s, d: reports.consistency_audit(derive.faulty_works(s, d), "micro"),
    "audit_meso": lambda s, d: reports.consistency_audit(derive.faulty_works(s, d), "meso"),
    "audit_bad_micro": lambda s, d: reports.inconsistent_clusters(derive.faulty_works(s, d), "micro"),
    "audit_bad_meso": lambda s, d: reports.inconsistent_clusters(derive.faulty_works(s, d), "meso"),
    "hierarchy_summary": lambda s, d: reports.hierarchy_summary(derive.faulty_works(s, d)),
    "size_distribution": _size_distribution,
    "size_coverage": lambda s, d: reports.size_coverage(
        reports.cluster_sizes(derive.works(s, d), "micro_cluster"), 12),
    "threshold_stats": _threshold_stats,
    "report_overview": lambda s, d: reports.overview(all_reports(s, d)),
    "level_counts": lambda s, d: reports.level_counts(derive.faulty_works(s, d)),
    "migrate_meso_as_micro": lambda s, d: migrate.promoted(
        derive.works(s, d).select("id", "micro_cluster", "meso_cluster", "macro_cluster"),
        version="v2", run_id="r1"),
    "migrate_projected_counts": lambda s, d: migrate.projected_counts(derive.works(s, d)),
    "largest_macro": lambda s, d: reports.largest_macro(report(s, d, "micro")),
}


def _profile(level: str) -> str:
    parents = {"micro": ("meso", "macro"), "meso": ("macro",)}[level]
    columns = [f"{level}_cluster", "count(*) AS docs"]
    columns += [f"count(DISTINCT {p}_cluster) AS {p}_distinct_nonnull" for p in parents]
    columns += [f"count(*) FILTER (WHERE {p}_cluster IS NULL) AS docs_null_{p}" for p in parents]
    return (f"profile AS (SELECT {', '.join(columns)} FROM faulty "
            f"WHERE {level}_cluster IS NOT NULL GROUP BY ALL)")


def _consistency(level: str) -> str:
    parents = {"micro": ("meso", "macro"), "meso": ("macro",)}[level]
    checks = [f"count(*) AS {level}_total"]
    for p in parents:
        checks += [f"count(*) FILTER (WHERE docs_null_{p} > 0) AS {level}_with_any_null_{p}",
                   f"count(*) FILTER (WHERE {p}_distinct_nonnull = 0) AS {level}_without_any_{p}",
                   f"count(*) FILTER (WHERE {p}_distinct_nonnull > 1) AS {level}_with_multiple_{p}"]
    return f"WITH {q.FAULTY}, {_profile(level)} SELECT {', '.join(checks)} FROM profile"


def _bad(level: str) -> str:
    parents = {"micro": ("meso", "macro"), "meso": ("macro",)}[level]
    faults = " OR ".join(f"docs_null_{p} > 0 OR {p}_distinct_nonnull > 1" for p in parents)
    return (f"WITH {q.FAULTY}, {_profile(level)} SELECT * FROM profile WHERE {faults} "
            f"ORDER BY docs DESC, {level}_cluster LIMIT 20")


def _thresholds(level: str) -> str:
    values = ", ".join(f"({t})" for t in THRESHOLDS)
    return f"""SELECT '{level}' AS level, CAST(t AS BIGINT) AS threshold,
    count(*) FILTER (WHERE publications > t) AS clusters_above_threshold,
    round_even(CAST(100.0 * count(*) FILTER (WHERE publications > t) / count(*) AS DOUBLE) * 100.0, 0) / 100.0
      AS pct_clusters_above_threshold,
    count(*) AS total_clusters
  FROM report_{level}, (VALUES {values}) v(t) GROUP BY t"""


SQL = {
    "article_report": f"WITH {q.WORKS} SELECT * REPLACE ({q.FLAT_LISTS}) FROM works",
    **{f"cluster_report_{level}": f"WITH {q.WORKS}, {q.report(level)} SELECT * FROM report_{level}"
       for level in ("micro", "meso", "macro")},
    "audit_coverage": f"""WITH {q.FAULTY} SELECT count(*) AS docs_total,
      count(*) FILTER (WHERE micro_cluster IS NULL) AS docs_null_micro,
      count(*) FILTER (WHERE meso_cluster IS NULL) AS docs_null_meso,
      count(*) FILTER (WHERE macro_cluster IS NULL) AS docs_null_macro,
      count(*) FILTER (WHERE micro_cluster IS NOT NULL AND meso_cluster IS NULL) AS docs_micro_without_meso,
      count(*) FILTER (WHERE micro_cluster IS NOT NULL AND macro_cluster IS NULL) AS docs_micro_without_macro
      FROM faulty""",
    "audit_micro": _consistency("micro"),
    "audit_meso": _consistency("meso"),
    "audit_bad_micro": _bad("micro"),
    "audit_bad_meso": _bad("meso"),
    "hierarchy_summary": f"""WITH {q.FAULTY},
      a AS (SELECT micro_cluster, count(DISTINCT meso_cluster) AS me, count(DISTINCT macro_cluster) AS ma
            FROM faulty GROUP BY 1),
      b AS (SELECT meso_cluster, count(DISTINCT macro_cluster) AS ma FROM faulty
            WHERE meso_cluster IS NOT NULL GROUP BY 1)
      SELECT (SELECT count(*) FROM faulty) AS docs_total,
        (SELECT count(*) FROM faulty WHERE meso_cluster IS NULL) AS null_meso_docs,
        (SELECT count(*) FROM faulty WHERE macro_cluster IS NULL) AS null_macro_docs,
        (SELECT count(*) FROM a) AS micro_clusters, (SELECT count(*) FROM b) AS meso_clusters,
        (SELECT count(DISTINCT macro_cluster) FROM faulty) AS macro_clusters,
        (SELECT count(*) FROM a WHERE me = 0) AS micro_without_meso,
        (SELECT count(*) FROM a WHERE ma = 0) AS micro_without_macro,
        (SELECT count(*) FROM a WHERE me > 1) AS micro_with_multiple_meso,
        (SELECT count(*) FROM a WHERE ma > 1) AS micro_with_multiple_macro,
        (SELECT count(*) FROM b WHERE ma = 0) AS meso_without_macro,
        (SELECT count(*) FROM b WHERE ma > 1) AS meso_with_multiple_macro""",
    "size_distribution": f"""WITH {q.WORKS},
      sizes AS (SELECT micro_cluster, count(*) AS members FROM works GROUP BY 1)
      SELECT * FROM (SELECT *, 'largest' AS side FROM sizes ORDER BY members DESC, micro_cluster LIMIT 20)
      UNION ALL
      SELECT * FROM (SELECT *, 'smallest' AS side FROM sizes ORDER BY members, micro_cluster LIMIT 20)""",
    "size_coverage": f"""WITH {q.WORKS},
      sizes AS (SELECT micro_cluster, count(*) AS members FROM works GROUP BY 1)
      SELECT count(*) AS clusters, count(*) FILTER (WHERE members >= 12) AS clusters_at_least,
        {q.rounded('100.0 * count(*) FILTER (WHERE members >= 12) / count(*)', 2)} AS pct_clusters,
        {q.rounded('100.0 * sum(members) FILTER (WHERE members >= 12) / sum(members)', 2)} AS pct_members
      FROM sizes""",
    "threshold_stats": f"WITH {q.REPORTS} " + " UNION ALL ".join(
        _thresholds(level) for level in ("micro", "meso", "macro")),
    "report_overview": f"""WITH {q.REPORTS}
      SELECT 'papers' AS metric, CAST(sum(publications) AS BIGINT) AS value FROM report_micro
      UNION ALL SELECT 'micro_clusters', count(*) FROM report_micro
      UNION ALL SELECT 'meso_clusters', count(*) FROM report_meso
      UNION ALL SELECT 'macro_clusters', count(*) FROM report_macro""",
    "level_counts": f"""WITH {q.FAULTY} SELECT count(*) AS rows_total,
      count(DISTINCT micro_cluster) AS distinct_micro, count(DISTINCT meso_cluster) AS distinct_meso,
      count(DISTINCT macro_cluster) AS distinct_macro FROM faulty""",
    "migrate_meso_as_micro": f"""WITH {q.WORKS} SELECT id, meso_cluster AS micro_cluster, meso_cluster,
      macro_cluster, micro_cluster AS micro_cluster_original,
      'meso_as_micro' AS micro_assignment_policy, 'v2' AS micro_assignment_version,
      'r1' AS micro_assignment_run_id FROM works""",
    "migrate_projected_counts": f"""WITH {q.WORKS} SELECT count(*) AS rows_total,
      count(DISTINCT meso_cluster) AS distinct_micro, count(DISTINCT meso_cluster) AS distinct_meso,
      count(DISTINCT macro_cluster) AS distinct_macro FROM works""",
    "largest_macro": f"""WITH {q.MICRO} SELECT macro_cluster, count(*) AS micro_clusters
      FROM report_micro GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
}
