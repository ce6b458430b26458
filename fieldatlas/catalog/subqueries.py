"""Cluster selection, codes, entity tables and the institution report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas import derive
from fieldatlas.catalog import fragments as q
from fieldatlas.catalog.reports import all_reports, flat_lists, report, report_of
from fieldatlas.functions.numbers import round_to
from fieldatlas.operators import selection
from fieldatlas.operators.reports import entity_stats, top_articles
from fieldatlas.plans import institution, keywords, subquery
from fieldatlas.session import Scratch

RULES = ("publications>=10", "ave_citations >= 40", "recency_py<=0.3")
INSTITUTION = "Brand#7"


def centroids(spark: SparkSession, folder: str) -> DataFrame:
    return derive.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("micro_cluster"), "embedding")


def query_vector(spark: SparkSession, folder: str) -> list[float]:
    return derive.table(spark, folder, "embeddings").where("vec_id = 0").first()["embedding"]


def _topic_search(spark: SparkSession, folder: str) -> DataFrame:
    chosen, matches = subquery.by_topic(
        {"micro": report(spark, folder, "micro")}, centroids(spark, folder),
        query_vector(spark, folder), Scratch(spark), threshold=0.1, min_size=5)
    return matches.select("micro_cluster", "publications",
                          round_to(F.col("similarity"), 6).alias("similarity"))


def _calibration(spark: SparkSession, folder: str) -> DataFrame:
    scores = selection.cosine_scores(centroids(spark, folder), query_vector(spark, folder))
    return selection.most_similar(scores).select(
        "micro_cluster", round_to(F.col("similarity"), 6).alias("similarity"))


def _filter_rules(spark: SparkSession, folder: str) -> DataFrame:
    return subquery.by_filters({"micro": report(spark, folder, "micro")}, RULES, Scratch(spark), min_size=8)[1]


def _rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    return selection.rule_counts(report(spark, folder, "micro"), [selection.parse_rule(r) for r in RULES])


def _passthrough(spark: SparkSession, folder: str) -> DataFrame:
    return subquery.everything({"micro": report(spark, folder, "micro")}, Scratch(spark))[1]


def _codes(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    return selection.with_cluster_codes(scratch.save(report(spark, folder, "micro")), scratch).select(
        "micro_cluster", "macro_cluster", "publications", "cluster_code")


def _code_sort(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    ordered = selection.sort_by_code(_codes(spark, folder), "micro", F.col("micro_cluster").asc())
    number = selection.with_position(
        ordered, [*selection.code_order(F.col("cluster_code"), True), F.col("micro_cluster").asc()],
        "place", scratch)
    return number.select("cluster_code", "place")


def _display_ids(spark: SparkSession, folder: str) -> DataFrame:
    return selection.with_display_ids(report(spark, folder, "micro"), "micro_cluster", Scratch(spark),
                                      "yearly_rank_citations").select("micro_cluster", "display_id")


def _subset_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    scratch = Scratch(spark)
    found = all_reports(spark, folder)
    chosen, matches = subquery.by_filters(found, RULES, scratch, min_size=8)
    return subquery.subsets(chosen, matches, found, derive.works(spark, folder))


def _subset(name: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _subset_tables(spark, folder)[name]
    return query


def _subquery_summary(spark: SparkSession, folder: str) -> DataFrame:
    tables = _subset_tables(spark, folder)
    return subquery.summary(*[tables[f"cluster_report_{level}"] for level in ("micro", "meso", "macro")])


def _institution_summary(works: DataFrame, scratch: Scratch) -> DataFrame:
    return institution.cluster_summary(report_of(works, "micro"), works, INSTITUTION, scratch)


def _institution_focus(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    return _institution_summary(scratch.save(derive.works(spark, folder)), scratch)


def _institution_top(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    works = scratch.save(derive.works(spark, folder))  # read by the report and twice for the institution
    return institution.top_works(scratch.save(_institution_summary(works, scratch)), works, INSTITUTION)


QUERIES = {
    "topic_search": _topic_search,
    "similarity_calibration": _calibration,
    "filter_rules": _filter_rules,
    "filter_rule_counts": _rule_counts,
    "passthrough_matches": _passthrough,
    "cluster_codes": _codes,
    "code_sort": _code_sort,
    "display_ids": _display_ids,
    "top_articles": lambda s, d: top_articles(derive.works(s, d), "micro_cluster", 10).select(
        "id", "micro_cluster", "citations"),
    "top_countries": lambda s, d: entity_stats(derive.works(s, d), "micro_cluster", "countries", "country", 20),
    "top_institutions": lambda s, d: entity_stats(derive.works(s, d), "meso_cluster", "institutions",
                                                  "institution", 20),
    "subset_article_top10": lambda s, d: flat_lists(_subset_tables(s, d)["article_top10"]),
    "subset_report_meso": _subset("cluster_report_meso"),
    "subset_top_countries": _subset("top_countries"),
    "subquery_summary": _subquery_summary,
    "representatives": lambda s, d: keywords.representatives(derive.works(s, d), Scratch(s)).select(
        "id", "micro_cluster", "meso_cluster", "macro_cluster"),
    "institution_focus": _institution_focus,
    "institution_top10": _institution_top,
}

_CODES = """base AS (SELECT micro_cluster, macro_cluster, max(publications) AS p FROM report_micro GROUP BY 1, 2),
mr AS (SELECT macro_cluster, row_number() OVER (ORDER BY sum(p) DESC, macro_cluster) AS m FROM base GROUP BY 1),
codes AS (SELECT micro_cluster, macro_cluster, m || '-' || row_number() OVER (
    PARTITION BY macro_cluster ORDER BY p DESC, micro_cluster) AS cluster_code, m,
    row_number() OVER (PARTITION BY macro_cluster ORDER BY p DESC, micro_cluster) AS k
  FROM base JOIN mr USING (macro_cluster))"""
_DOT = "list_inner_product(CAST(e.embedding AS DOUBLE[]), CAST(z.embedding AS DOUBLE[]))"
_SCORES = f"""scores AS (SELECT e.vec_id AS micro_cluster, {_DOT} AS similarity
  FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) z)"""
_CHOSEN = """chosen AS (SELECT * FROM report_micro WHERE publications >= 10 AND ave_citations >= 40
  AND recency_py <= 0.3 AND publications >= 8)"""


def _entities(key: str, values: str, name: str, top: int, source: str = "works") -> str:
    return f"""SELECT {key}, {name}, freq, avg_publication_year, avg_citation FROM (
      SELECT {key}, {name}, count(*) AS freq, {q.rounded('avg(publication_year)', 1)} AS avg_publication_year,
        {q.rounded('avg(citations)', 2)} AS avg_citation,
        row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {name} ASC NULLS LAST) AS rn
      FROM (SELECT {key}, publication_year, citations, unnest({values}) AS {name} FROM {source})
      GROUP BY {key}, {name}) WHERE rn <= {top}"""


_OWN = f"""own AS (SELECT DISTINCT id, title, publication_year, citations, micro_cluster, meso_cluster, macro_cluster
  FROM works WHERE list_contains(institutions, '{INSTITUTION}')),
shown AS (SELECT *, row_number() OVER (ORDER BY publications DESC, yearly_rank_citations DESC, micro_cluster)
  AS display_id FROM report_micro)"""
_ARTICLES = ("id, title, citations, micro_cluster, meso_cluster, macro_cluster, publication_year, "
             + q.FLAT_LISTS)

SQL = {
    "topic_search": f"""WITH {q.MICRO}, {_SCORES}
      SELECT micro_cluster, publications, {q.rounded('similarity', 6)} AS similarity
      FROM scores JOIN report_micro USING (micro_cluster) WHERE similarity >= 0.1 AND publications >= 5""",
    "similarity_calibration": f"""WITH {_SCORES} SELECT micro_cluster, {q.rounded('similarity', 6)} AS similarity
      FROM scores ORDER BY scores.similarity DESC, micro_cluster LIMIT 10""",
    "filter_rules": f"""WITH {q.MICRO}, {_CHOSEN} SELECT micro_cluster, publications, meso_cluster, macro_cluster,
      ave_citations, recency_py, '{' AND '.join(RULES)}' AS filters_applied FROM chosen""",
    "filter_rule_counts": f"""WITH {q.MICRO} SELECT count(*) AS all_rows,
      count(*) FILTER (WHERE publications >= 10) AS after_rule_1,
      count(*) FILTER (WHERE publications >= 10 AND ave_citations >= 40) AS after_rule_2,
      count(*) FILTER (WHERE publications >= 10 AND ave_citations >= 40 AND recency_py <= 0.3) AS after_rule_3
      FROM report_micro""",
    "passthrough_matches": f"""WITH {q.MICRO} SELECT micro_cluster, publications, meso_cluster, macro_cluster,
      'passthrough_all' AS filters_applied FROM report_micro""",
    "cluster_codes": f"""WITH {q.MICRO}, {_CODES} SELECT micro_cluster, macro_cluster, publications, cluster_code
      FROM report_micro JOIN codes USING (micro_cluster, macro_cluster)""",
    "code_sort": f"""WITH {q.MICRO}, {_CODES} SELECT cluster_code, row_number() OVER (ORDER BY m, k) - 1 AS place
      FROM codes""",
    "display_ids": f"""WITH {q.MICRO}, {_OWN} SELECT micro_cluster, display_id FROM shown""",
    "top_articles": f"""WITH {q.WORKS} SELECT id, micro_cluster, citations FROM (
      SELECT *, row_number() OVER (PARTITION BY micro_cluster ORDER BY citations DESC NULLS LAST, id) AS rn FROM works)
      WHERE rn <= 10""",
    "top_countries": f"WITH {q.WORKS} " + _entities("micro_cluster", "countries", "country", 20),
    "top_institutions": f"WITH {q.WORKS} " + _entities("meso_cluster", "institutions", "institution", 20),
    "subset_article_top10": f"""WITH {q.MICRO}, {_CHOSEN} SELECT {_ARTICLES} FROM (
      SELECT *, row_number() OVER (PARTITION BY micro_cluster ORDER BY citations DESC NULLS LAST, id) AS rn
      FROM works WHERE micro_cluster IN (SELECT micro_cluster FROM chosen)) WHERE rn <= 10""",
    "subset_report_meso": f"""WITH {q.REPORTS}, {_CHOSEN} SELECT * FROM report_meso
      WHERE meso_cluster IN (SELECT meso_cluster FROM chosen)""",
    "subset_top_countries": f"""WITH {q.MICRO}, {_CHOSEN},
      inside AS (SELECT * FROM works WHERE micro_cluster IN (SELECT micro_cluster FROM chosen)) """
      + _entities("micro_cluster", "countries", "country", 20, "inside"),
    "subquery_summary": f"""WITH {q.MICRO}, {_CHOSEN} SELECT count(*) AS micro_clusters,
      CAST(sum(publications) AS BIGINT) AS papers, count(DISTINCT meso_cluster) AS meso_clusters,
      count(DISTINCT macro_cluster) AS macro_clusters FROM chosen""",
    "representatives": f"""WITH {q.WORKS} SELECT id, micro_cluster, meso_cluster, macro_cluster FROM (
      SELECT *, row_number() OVER (PARTITION BY micro_cluster ORDER BY citations DESC NULLS LAST, id) AS rn,
        count(*) OVER (PARTITION BY micro_cluster) AS n
      FROM works WHERE micro_cluster IS NOT NULL AND title IS NOT NULL)
      WHERE rn <= greatest(5, (n + 99) // 100)""",
    "institution_focus": f"""WITH {q.MICRO}, {_OWN},
      agg AS (SELECT micro_cluster, count(*) AS publications_own, {q.rounded('avg(publication_year)', 1)} AS ave_py_own,
        {q.rounded('avg(citations)', 2)} AS ave_citations_own FROM own GROUP BY 1)
      SELECT micro_cluster, display_id, micro_cluster AS global_id, meso_cluster, macro_cluster,
        publications AS publications_total, ave_py AS ave_py_total, ave_citations AS ave_citations_total,
        publications_own, ave_py_own, ave_citations_own,
        round_even(CAST(publications_own AS DOUBLE) / publications * 10000.0, 0) / 10000.0 AS pct_own
      FROM shown JOIN agg USING (micro_cluster)""",
    "institution_top10": f"""WITH {q.MICRO}, {_OWN} SELECT o.*, display_id, s.micro_cluster AS global_id,
        '{INSTITUTION}' AS institution
      FROM (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
          PARTITION BY micro_cluster ORDER BY citations DESC NULLS LAST, id) AS rn FROM own) WHERE rn <= 10) o
      JOIN shown s USING (micro_cluster)""",
}
