"""Report packs: cluster sheets, article sheets, entity sheets and the nested payload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldatlas.functions import text
from fieldatlas.functions.colors import stored_or_stable
from fieldatlas.operators.ranking import first_per_key, top_n, with_group_rank
from fieldatlas.operators.reports import cluster_column, entity_stats, top_articles
from fieldatlas.operators.selection import restrict, sort_by_code, with_cluster_codes, with_display_ids
from fieldatlas.session import Scratch
from fieldatlas.sources.writers import write_csv, write_json, write_table

NAME_FIELDS = ("short_name", "name", "description")
_NO_NAMES = T.StructType([T.StructField("cluster", T.LongType())]
                         + [T.StructField(c, T.StringType()) for c in NAME_FIELDS])


def country_table(spark: SparkSession) -> DataFrame:
    """Country names by two-letter code, from the runtime's own locale data."""
    locale = spark._jvm.java.util.Locale
    rows = [(str(code), str(locale("", code).getDisplayCountry(locale.ENGLISH)))
            for code in locale.getISOCountries()]
    return spark.createDataFrame(rows, "code string, country_name string")


def country_names(df: DataFrame, countries: DataFrame, column: str = "country") -> DataFrame:
    """Replace known codes by names; other values stay as they are, null becomes ''."""
    known = countries.select(F.upper("code").alias("_code"), F.col("country_name").alias("_name"))
    out = df.join(known, F.upper(F.trim(column)) == F.col("_code"), "left")
    name = F.coalesce("_name", text.clean(F.col(column)))
    # Fixed value: the preferred display name.
    name = F.when(name == "Taiwan, Province of China", "Taiwan").otherwise(name)
    return out.withColumn(column, name).drop("_code", "_name")


def cluster_sheet(report: DataFrame, level: str, scratch: Scratch, names: DataFrame | None = None,
                  tie_break: str | None = None) -> DataFrame:
    """Clusters of a level with display id, code and names, in code order.

    ``names`` has cluster, short_name, name and description; a given name
    replaces the report's own.
    """
    key = cluster_column(level)
    if level == "micro":
        report = scratch.save(with_cluster_codes(scratch.save(report), scratch, keep_valid=True))
    rows = with_display_ids(report.where(F.col(key).isNotNull()), key, scratch, tie_break)
    if level != "micro":
        rows = rows.withColumn("cluster_code", F.col("display_id").cast("string"))
    given = names if names is not None else report.sparkSession.createDataFrame([], _NO_NAMES)
    given = first_per_key(given, ["cluster"], [F.col("name").asc_nulls_last()])
    given = given.select(F.col("cluster").alias(key), *[F.col(c).alias(f"_{c}") for c in NAME_FIELDS])
    rows = rows.join(given, key, "left")
    for c in NAME_FIELDS:
        own = F.col(c) if c in report.columns else F.lit("")
        rows = rows.withColumn(c, text.clean(F.coalesce(F.col(f"_{c}"), own))).drop(f"_{c}")
    first = ["display_id", "cluster_code", key, *NAME_FIELDS, "publications"]
    rows = rows.select(*first, *[c for c in rows.columns if c not in first])
    return sort_by_code(rows, level, F.col("display_id").asc(), F.col(key).asc())


def with_macro_display(micro_sheet: DataFrame, macro_sheet: DataFrame) -> DataFrame:
    """Add the macro cluster's display id to the micro sheet."""
    shown = macro_sheet.select("macro_cluster", F.col("display_id").alias("macro_cluster_id"))
    return micro_sheet.join(shown, "macro_cluster", "left")


def article_sheet(articles: DataFrame, sheet: DataFrame, level: str, meta: DataFrame, n: int = 20) -> DataFrame:
    """Top cited works of every cluster with authors, source and abstract.

    ``meta`` has article_id, authors (array), publication_source and abstract.
    """
    key = cluster_column(level)
    best = top_articles(restrict(articles, sheet, key), key, n)
    facts = first_per_key(restrict(meta.withColumnRenamed("article_id", "id"), best, "id"), ["id"], [
        F.col("abstract").asc_nulls_last(), F.col("publication_source").asc_nulls_last(), F.col("authors").asc_nulls_last()])
    code = sheet.select(key, "cluster_code")
    rows = best.select("id", "title", "publication_year", "citations", key) \
        .join(facts, "id", "left").join(code, key, "left").select(
            "cluster_code", text.clean(F.col("id")).alias("article_id"), "title",
            text.clean(F.col("abstract")).alias("abstract"),
            F.col("publication_year").try_cast("bigint").alias("year"), F.col("citations").alias("citation"),
            text.joined_names(F.col("authors")).alias("authors"),
            text.clean(F.col("publication_source")).alias("publication_source"), key)
    return sort_by_code(rows, level, F.col("citation").desc_nulls_last(), F.col("article_id").asc())


def entity_sheet(articles: DataFrame, sheet: DataFrame, level: str, values: str, name: str,
                 countries: DataFrame | None = None, top: int = 100) -> DataFrame:
    """Leading entities per cluster by code; blank names go before the cut."""
    key = cluster_column(level)
    stats = entity_stats(restrict(articles, sheet, key), key, values, name)
    stats = stats.where(text.clean(F.col(name)) != "")
    stats = top_n(stats, [key], [F.col("freq").desc(), F.col(name).asc()], top)
    if countries is not None:
        stats = country_names(stats, countries, name)
    stats = stats.withColumn(name, text.clean(F.col(name)))
    rows = stats.join(sheet.select(key, "cluster_code"), key, "left").withColumn(
        "cluster_code", text.clean(F.col("cluster_code"))).select(
        "cluster_code", name, "freq", "avg_publication_year", "avg_citation")
    return sort_by_code(rows, level, F.col("freq").desc(), F.col(name).asc())


def level_info(sheet: DataFrame, level: str, snapshot: str, query: str, subquery: str) -> DataFrame:
    """Item and value rows describing one level of a report."""
    totals = sheet.agg(F.coalesce(F.sum(F.col("publications").try_cast("double")), F.lit(0.0))
                       .cast("bigint").cast("string").alias("documents"),
                       F.count(F.lit(1)).cast("string").alias("clusters"))
    fixed = {"data": f"snapshot_{snapshot}", "query": query, "subquery": subquery, "level": level}
    pairs = [F.struct(F.lit(k).alias("item"), F.lit(v).alias("value")) for k, v in fixed.items()]
    pairs += [F.struct(F.lit(k).alias("item"), F.col(k).alias("value")) for k in ("documents", "clusters")]
    return totals.select(F.explode(F.array(*pairs)).alias("r")).select("r.item", "r.value")


def write_pack(articles: DataFrame, reports: dict[str, DataFrame], meta: DataFrame, target: str,
               snapshot: str, query: str, subquery: str, countries: DataFrame,
               names: DataFrame | None = None, macro_names: DataFrame | None = None) -> dict[str, dict[str, int]]:
    """Write article, profile, country and institution tables of every level."""
    counts: dict[str, dict[str, int]] = {}
    scratch = Scratch(articles.sparkSession)
    sheets = {
        "macro": cluster_sheet(reports["macro"], "macro", scratch, macro_names),
        "meso": cluster_sheet(reports["meso"], "meso", scratch),
        "micro": cluster_sheet(reports["micro"], "micro", scratch, names, "yearly_rank_citations")}
    sheets["micro"] = with_macro_display(sheets["micro"], sheets["macro"])
    for level, sheet in sheets.items():
        sheet = scratch.save(sheet)
        place = f"{target}/{level}"
        counts[level] = {
            "article_report_top20": write_table(article_sheet(articles, sheet, level, meta),
                                                f"{place}/article_report_top20"),
            "cluster_profile": write_table(sheet.drop("display_id"), f"{place}/cluster_profile")}
        write_csv(level_info(sheet, level, snapshot, query, subquery), f"{place}/info")
        write_csv(entity_sheet(articles, sheet, level, "countries", "country", countries),
                  f"{place}/countries_summary")
        write_csv(entity_sheet(articles, sheet, level, "institutions", "institution"),
                  f"{place}/institutions_summary")
    return counts


# --- nested report -----------------------------------------------------------

def _list_per_cluster(rows: DataFrame, order: list, fields: list[str], n: int, name: str) -> DataFrame:
    """At most n rows of each micro cluster as one ordered array of structs."""
    best = top_n(rows, ["micro_cluster"], order, n, "_rank")
    return best.groupBy("micro_cluster").agg(
        F.array_sort(F.collect_list(F.struct("_rank", F.struct(*fields).alias("row")))).alias("_l")) \
        .select("micro_cluster", F.col("_l.row").alias(name))


def report_clusters(micro: DataFrame, papers: DataFrame, countries: DataFrame, institutions: DataFrame,
                    keywords: DataFrame, scratch: Scratch, names: DataFrame | None = None,
                    macro_names: DataFrame | None = None, macro_colors: DataFrame | None = None,
                    titles: int = 10, entities: int = 20, country_table: DataFrame | None = None) -> DataFrame:
    """One nested row per micro cluster: metrics, names, titles and entities.

    Arrays hold at most ``titles`` or ``entities`` rows, chosen after blank names
    are gone, so ``countries`` and ``institutions`` are given uncut.  Of several
    rows for one key the first in text order counts.  ``country_table`` turns
    country codes into names.
    """
    spark = micro.sparkSession
    key, macro = "micro_cluster", F.col("macro_cluster")
    rows = with_display_ids(micro, key, scratch, "yearly_rank_citations")
    given = names if names is not None else spark.createDataFrame([], _NO_NAMES)
    given = given.select(F.col("cluster").alias(key), *[text.blank_to_null(F.col(c)).alias(c) for c in NAME_FIELDS])
    given = first_per_key(given, [key], [F.col(c).asc_nulls_last() for c in ("name", "short_name", "description")])
    labels = macro_names if macro_names is not None else spark.createDataFrame([], "macro_cluster bigint, name string")
    colors = macro_colors if macro_colors is not None else spark.createDataFrame(
        [], "macro_cluster bigint, color_hex string")

    if country_table is not None:
        countries = country_names(countries, country_table)
    lists = [
        _list_per_cluster(
            papers.select(key, text.clean(F.col("title")).alias("title"),
                          F.coalesce("citations", F.lit(0)).alias("citations"), "publication_year", "id",
                          F.col("citations").alias("_cited")),
            [F.col("_cited").desc_nulls_last(), F.col("id").asc()],
            ["title", "citations", "publication_year"], titles, "top_titles"),
        *[_list_per_cluster(
            df.where(~text.is_blank_like(F.col(name))).withColumn(name, text.clean(F.col(name))),
            [F.col("freq").desc(), F.col(name).asc()],
            [name, "freq", "avg_publication_year", "avg_citation"], entities, column)
          for df, name, column in ((countries, "country", "countries"),
                                   (institutions, "institution", "institutions"))]]
    words = first_per_key(keywords.select(F.col("cluster").alias(key), "keywords"), [key],
                          [F.col("keywords").asc_nulls_last()])
    labels = first_per_key(labels.select("macro_cluster", F.col("name").alias("_label")), ["macro_cluster"],
                           [F.col("_label").asc_nulls_last()])
    colors = first_per_key(colors.select("macro_cluster", F.col("color_hex").alias("_color")), ["macro_cluster"],
                           [F.col("_color").asc_nulls_last()])
    rows = rows.join(given, key, "left").join(words, key, "left") \
        .join(labels, "macro_cluster", "left").join(colors, "macro_cluster", "left")
    for part in lists:
        rows = rows.join(part, key, "left")

    auto = text.keyword_title(F.col("keywords"))
    unnamed = F.col("short_name").isNull() & (auto == "Unnamed Cluster")
    numbered = F.concat(F.lit("Cluster "), F.col(key).cast("string"))
    short = F.when(unnamed, numbered).otherwise(F.coalesce("short_name", auto))
    long = F.when(unnamed, numbered).otherwise(F.coalesce("name", "short_name", auto))
    return rows.select(
        "display_id", F.col(key).alias("global_id"), short.alias("short_name"), long.alias("name"),
        F.coalesce("description", F.lit("")).alias("description"), "publications",
        F.col("ave_py").alias("avg_publication_year"), F.col("ave_citations").alias("avg_citation"),
        F.col("yearly_rank_citations").alias("ranked_citation_score"), F.col("recency_py").alias("recency"),
        F.coalesce("japan_count", F.lit(0)).alias("japan"), "macro_cluster",
        F.when(macro.isNull(), "Unknown").otherwise(F.coalesce("_label", F.lit("Unknown"))).alias("macro_cluster_label"),
        F.when(macro.isNull(), "#7f7f7f").otherwise(stored_or_stable(F.col("_color"), macro)).alias("macro_color"),
        "top_titles", "countries", "institutions")


def payload_totals(clusters: DataFrame) -> DataFrame:
    """Totals of a report as one row."""
    return clusters.agg(
        F.coalesce(F.sum("publications"), F.lit(0)).alias("total_publications"),
        F.count(F.lit(1)).alias("total_clusters"),
        F.countDistinct(F.coalesce(F.col("macro_cluster").cast("string"), F.lit("Unknown")))
        .alias("total_macro_clusters"))


def write_report(clusters: DataFrame, target: str) -> None:
    """Write clusters, series and totals of a nested report as JSON lines."""
    scratch = Scratch(clusters.sparkSession)
    clusters = scratch.save(clusters)
    write_json(clusters, f"{target}/clusters")
    write_json(scatter_series(clusters, scratch), f"{target}/series")
    write_json(payload_totals(clusters), f"{target}/totals")


def scatter_series(clusters: DataFrame, scratch: Scratch, by_macro: bool = True) -> DataFrame:
    """Points of every series in drawing order, one row per point.

    A series can hold any share of all clusters, so it stays rows; a reader
    takes one series with a filter and its order from ``point``.
    """
    series = F.col("macro_cluster_label") if by_macro else F.lit("All Clusters")
    color = F.col("macro_color") if by_macro else F.lit("#005f73")
    rows = clusters.select(
        series.alias("series"), color.alias("color"), F.col("avg_publication_year").alias("x"),
        F.col("ranked_citation_score").alias("y"), F.col("publications").alias("size"),
        F.concat_ws("-", F.col("display_id").cast("string"), "short_name").alias("text"), "display_id")
    return with_group_rank(rows, ["series"], [F.col("display_id").asc()], "point", scratch).drop("display_id")
