"""Report packs, the nested report and chart tables."""

from __future__ import annotations

import colorsys

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas import derive
from fieldatlas.catalog import fragments as q
from fieldatlas.catalog.reports import all_reports, report, report_of
from fieldatlas.catalog.texts import COLORS, macro_colors, macro_names
from fieldatlas.functions.codes import clean_code, display_label, main_code
from fieldatlas.functions.numbers import round_to
from fieldatlas.operators.reports import entity_stats
from fieldatlas.operators.vectors import on_plane
from fieldatlas.plans import charts, packs
from fieldatlas.session import Scratch

PALETTE = ["#1f77b4", "#ff7f0e", "#2ca02c"]


def _micro_names(spark: SparkSession, folder: str) -> DataFrame:
    """Customer names as cluster names, missing for customers in debt."""
    return derive.table(spark, folder, "customer").where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("cluster"), F.col("c_mktsegment").alias("short_name"),
        F.col("c_name").alias("name"), F.lower("c_mktsegment").alias("description"))


def _bars(level: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        names = _micro_names(spark, folder).withColumnRenamed("cluster", "micro_cluster")
        return charts.bar_table(report(spark, folder, level), level, macro_colors(spark, folder).where("macro_cluster <> 2"),
                                Scratch(spark), names, min_size=8, top_per_parent=30, macros_per_panel=2)
    return query


def _scatter(level: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return charts.scatter_table(report(spark, folder, level), level, macro_colors(spark, folder),
                                    Scratch(spark), min_size=5, y="rank_metric", min_x=1995.0, min_y=0.4)
    return query


_ENTRIES = 64  # of each vector of the test tables


def _points(spark: SparkSession, folder: str) -> DataFrame:
    """Whole vectors on two fixed axes: the sum of all entries, and that of the even less that of the odd ones."""
    axes = np.column_stack([np.ones(_ENTRIES), np.where(np.arange(_ENTRIES) % 2 == 0, 1.0, -1.0)])
    return on_plane(derive.table(spark, folder, "embeddings"), axes).select(
        F.col("vec_id").alias("id"), F.col("label").cast("bigint").alias("cluster"),
        round_to(F.col("x_coords"), 6).alias("x"), round_to(F.col("y_coords"), 6).alias("y"))


def _anchors(spark: SparkSession, folder: str) -> DataFrame:
    return charts.label_anchors(_points(spark, folder), ["cluster"], Scratch(spark), at_least=20)


def _layers(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    micro = report(spark, folder, "micro")
    at = points.select(F.col("id").alias("cluster"), "x", "y")

    def level(key: str) -> DataFrame:
        return at.join(micro.select(F.col(key).alias("cluster")).distinct(), "cluster", "left_semi")

    found = charts.map_layers({"micro": at, "meso": level("meso_cluster"), "macro": level("macro_cluster")}, micro)
    return found.withColumn("marker", round_to(F.col("marker"), 4))


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    docs = derive.table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    meta = derive.table(spark, folder, "region").select(
        F.col("r_regionkey").cast("bigint").alias("cluster"),
        F.concat(F.col("r_regionkey").cast("string"), F.lit("-0---")).alias("cluster_code"),
        F.col("r_name").alias("cluster_name"), F.when(F.col("r_regionkey") < 2, "nan").alias("global_name"))
    points = _points(spark, folder)
    return charts.labelled_points(docs.join(points.select("id", "cluster"), "id"),
                                  points.select("id", "x", "y"), meta)


def _facets(spark: SparkSession, folder: str) -> DataFrame:
    rows = derive.table(spark, folder, "orders").join(
        derive.table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return charts.facet_frequency(rows.select(F.concat_ws("; ", "o_orderpriority", "c_mktsegment").alias("facets")),
                                  "facets")


def _codes(spark: SparkSession, folder: str) -> DataFrame:
    """Part codes 'brand-part' with the marks older files carry."""
    part, at = derive.table(spark, folder, "part"), F.col("p_partkey")
    mark = F.when(at % 3 == 0, "---").when(at % 3 == 1, "-0").otherwise("")
    return part.select(
        F.concat(F.substring_index("p_brand", "#", -1), F.lit("-"), at.cast("string"), mark).alias("cluster_code"),
        F.when(at % 4 == 0, F.lit(" nan ")).when(at % 4 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("Field of "), F.col("p_name"))).alias("global_name"),
        F.when(at % 8 != 0, F.col("p_name")).otherwise("").alias("cluster_name"))


def _cluster_labels(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("cluster_code")
    return _codes(spark, folder).select(
        "cluster_code", clean_code(code).alias("cleaned"), main_code(code).alias("main_cluster"),
        display_label(code, F.col("global_name"), F.col("cluster_name"), 35).alias("label"))


def _color_ramp(spark: SparkSession, folder: str) -> DataFrame:
    found = charts.cluster_colors(_codes(spark, folder).select("cluster_code"), PALETTE, Scratch(spark))
    return found.select("cluster_code", "main_cluster", "color", round_to(F.col("lightness"), 6).alias("lightness"))


def _color_shades(spark: SparkSession, folder: str) -> DataFrame:
    """A palette that starts again after its last colour, and the shade of every sub-cluster."""
    return charts.cluster_colors(_codes(spark, folder).select("cluster_code"), PALETTE, Scratch(spark), recycle=True) \
                 .select("cluster_code", "color", "sub_color")


def _plot_clusters(spark: SparkSession, folder: str) -> DataFrame:
    rows = derive.table(spark, folder, "part").select(
        F.concat_ws("-", F.col("p_size").cast("string"), F.col("p_partkey").cast("string")).alias("cluster_code"),
        (F.col("p_partkey") % 30).alias("documents"))
    return charts.plot_clusters(rows, facet=True)


# --- packs ---------------------------------------------------------------------

def _micro_sheet(spark: SparkSession, folder: str, scratch: Scratch) -> DataFrame:
    return packs.cluster_sheet(report(spark, folder, "micro"), "micro", scratch,
                               _micro_names(spark, folder), "yearly_rank_citations")


def _cluster_sheet(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    reports = all_reports(spark, folder)
    macro = packs.cluster_sheet(reports["macro"], "macro", scratch)
    micro = packs.cluster_sheet(reports["micro"], "micro", scratch, _micro_names(spark, folder),
                                "yearly_rank_citations")
    return packs.with_macro_display(micro, macro).select(
        "display_id", "cluster_code", "micro_cluster", "short_name", "name", "description", "publications",
        "macro_cluster_id")


def _article_sheet(spark: SparkSession, folder: str) -> DataFrame:
    sheet = packs.cluster_sheet(report(spark, folder, "meso"), "meso", Scratch(spark))
    meta = derive.document_nodes(spark, folder).select(
        F.col("id").alias("article_id"), F.array("language", F.lit(None), F.lit(" x ")).alias("authors"),
        "publication_source", "abstract")
    return packs.article_sheet(derive.works(spark, folder), sheet, "meso", meta)


def _country_lookup(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = derive.table(spark, folder, "nation"), derive.table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).where("r_name <> 'ASIA'").select(
        F.col("n_name").alias("code"), F.concat_ws(" ", "r_name", "n_name").alias("country_name"))


def _country_sheet(spark: SparkSession, folder: str) -> DataFrame:
    sheet = packs.cluster_sheet(report(spark, folder, "meso"), "meso", Scratch(spark))
    return packs.entity_sheet(derive.works(spark, folder), sheet, "meso", "countries", "country",
                              _country_lookup(spark, folder), top=10)


def _institution_sheet(spark: SparkSession, folder: str) -> DataFrame:
    sheet = packs.cluster_sheet(report(spark, folder, "macro"), "macro", Scratch(spark))
    return packs.entity_sheet(derive.works(spark, folder), sheet, "macro", "institutions", "institution")


def _level_info(spark: SparkSession, folder: str) -> DataFrame:
    return packs.level_info(report(spark, folder, "meso"), "meso", "2026-06-26", "orders", "all")


def _twice(rows: DataFrame, column: str) -> DataFrame:
    """Every row again with a value that sorts later; reports must not multiply."""
    return rows.unionByName(rows.withColumn(column, F.concat(column, F.lit("~"))))


def _clusters(spark: SparkSession, folder: str, scratch: Scratch) -> DataFrame:
    works = scratch.save(derive.works(spark, folder))  # read by the report, the titles and both entity lists
    words = derive.table(spark, folder, "customer").where("c_nationkey <> 3").select(
        F.col("c_custkey").alias("cluster"), F.concat_ws(", ", F.lower("c_mktsegment"), F.lit("deep-sea mining"))
        .alias("keywords"))
    return packs.report_clusters(
        report_of(works, "micro"), works, entity_stats(works, "micro_cluster", "countries", "country"),
        entity_stats(works, "micro_cluster", "institutions", "institution"), _twice(words, "keywords"), scratch,
        _twice(_micro_names(spark, folder), "name"), _twice(macro_names(spark, folder), "name"),
        _twice(macro_colors(spark, folder).where("macro_cluster <> 2"), "color_hex"),
        country_table=_country_lookup(spark, folder))


def _payload(spark: SparkSession, folder: str) -> DataFrame:
    def listed(column: str, field: str, count: str):
        return F.array_join(F.transform(column, lambda r: F.concat_ws(":", r[field], r[count].cast("string"))), "|")

    return _clusters(spark, folder, Scratch(spark)).select(
        "display_id", "global_id", "short_name", "name", "description", "publications", "japan",
        "macro_cluster_label", "macro_color", listed("top_titles", "title", "citations").alias("top_titles"),
        listed("countries", "country", "freq").alias("countries"),
        listed("institutions", "institution", "freq").alias("institutions"))


def _series(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    return packs.scatter_series(scratch.save(_clusters(spark, folder, scratch)), scratch)


QUERIES = {
    "bars_table_micro": _bars("micro"),
    "bars_table_meso": _bars("meso"),
    "bars_table_macro": _bars("macro"),
    "scatter_table_micro": _scatter("micro"),
    "scatter_table_meso": _scatter("meso"),
    "scatter_table_macro": _scatter("macro"),
    "label_anchors": _anchors,
    "map_layers": _layers,
    "labelled_points": _labelled,
    "facet_frequency": _facets,
    "yearly_counts": lambda s, d: charts.yearly_counts(derive.works(s, d)),
    "recent_years": lambda s, d: charts.recent_years(derive.works(s, d), 5),
    "cluster_labels": _cluster_labels,
    "color_ramp": _color_ramp,
    "color_shades": _color_shades,
    "plot_clusters": _plot_clusters,
    "cluster_sheet": _cluster_sheet,
    "article_pack": _article_sheet,
    "country_pack": _country_sheet,
    "institution_pack": _institution_sheet,
    "level_info": _level_info,
    "report_payload": _payload,
    "report_totals": lambda s, d: packs.payload_totals(_clusters(s, d, Scratch(s))),
    "scatter_series": _series,
}

# --- plain SQL --------------------------------------------------------------------

_NAMES = """given AS (SELECT c_custkey AS micro_cluster, c_mktsegment AS short_name, c_name AS name,
  lower(c_mktsegment) AS description FROM customer WHERE c_acctbal >= 0)"""


def _level(level: str, size: int, where: str = "true") -> str:
    """Coded, sized clusters of one level with the rank of their macro."""
    key = f"{level}_cluster"
    parent = key if level == "macro" else "macro_cluster"
    code = ("mr.m || '-' || row_number() OVER (PARTITION BY macro_parent ORDER BY publications DESC, cluster_id)"
            if level == "micro" else
            "CAST(row_number() OVER (ORDER BY publications DESC, cluster_id) AS VARCHAR)")
    return f"""lv AS (SELECT {key} AS cluster_id, {parent} AS macro_parent, CAST(publications AS DOUBLE) AS publications,
    ave_py, ave_citations, yearly_rank_citations AS rank_metric FROM report_{level} WHERE publications >= {size} AND {where}),
mr AS (SELECT macro_parent, row_number() OVER (ORDER BY sum(publications) DESC, macro_parent) AS m FROM lv GROUP BY 1),
coded AS (SELECT lv.*, m AS macro_display_id, {code} AS cluster_code FROM lv JOIN mr USING (macro_parent))"""


def _bars_sql(level: str) -> str:
    named = "coalesce(g.short_name, '')" if level == "micro" else "''"
    join = "LEFT JOIN given g ON g.micro_cluster = cluster_id" if level == "micro" else ""
    cut = "" if level == "macro" else "WHERE rn <= 30"
    label = f"CASE WHEN {named} = '' THEN cluster_code ELSE cluster_code || '. ' || {named} END"
    return f"""WITH {q.WORKS}, {q.report(level)}, {COLORS}, {_NAMES}, {_level(level, 8)},
      r AS (SELECT *, row_number() OVER (PARTITION BY macro_display_id ORDER BY publications DESC, cluster_id) AS rn FROM coded)
      SELECT cluster_id, macro_parent, macro_display_id, publications, cluster_code,
        CASE WHEN macro_parent = 2 THEN '#bfbfbf' ELSE color_hex END AS color_hex, {label} AS label_full, {label} AS label_text,
        (macro_display_id - 1) // 2 + 1 AS panel_id
      FROM r JOIN colors ON macro_cluster = macro_parent {join} {cut}"""


def _scatter_sql(level: str) -> str:
    return f"""WITH {q.WORKS}, {q.report(level)}, {COLORS}, {_level(level, 5)}
      SELECT cluster_id, macro_parent, macro_display_id, publications, ave_py, ave_citations, rank_metric,
        cluster_code, color_hex, cluster_code AS label_text
      FROM coded JOIN colors ON macro_cluster = macro_parent
      WHERE ave_py >= 1995 AND rank_metric >= 0.4 AND ave_citations IS NOT NULL"""


_POINTS = f"""pts AS (SELECT vec_id AS id, CAST(label AS BIGINT) AS cluster,
  {q.rounded('list_sum(CAST(embedding AS DOUBLE[]))', 6)} AS x,
  {q.rounded('list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda v, i: CASE WHEN i % 2 = 1 THEN v ELSE -v END))', 6)} AS y
  FROM embeddings)"""
_CODES = """codes AS (SELECT CAST(split_part(p_brand, '#', 2) AS INTEGER) AS r,
  split_part(p_brand, '#', 2) || '-' || p_partkey
    || CASE p_partkey % 3 WHEN 0 THEN '---' WHEN 1 THEN '-0' ELSE '' END AS cluster_code,
  CASE WHEN p_partkey % 4 IN (0, 1) THEN NULL ELSE 'Field of ' || p_name END AS gn,
  CASE WHEN p_partkey % 8 <> 0 THEN p_name END AS cn FROM part)"""
_SHOWN = """s AS (SELECT *, regexp_replace(regexp_replace(cluster_code, '-0$', ''), '---$', '') AS shown FROM codes),
n AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY shown, cluster_code) AS rn,
  count(*) OVER (PARTITION BY r) AS c, dense_rank() OVER (ORDER BY r) AS g FROM s)"""


def _palette_rows() -> str:
    """Place, colour, hue and saturation of the palette by the standard library."""
    rows = []
    for place, color in enumerate(PALETTE):
        hue, _, saturation = colorsys.rgb_to_hls(*[int(color[at:at + 2], 16) / 255 for at in (1, 3, 5)])
        rows.append(f"({place}, '{color}', {hue!r}::DOUBLE, {saturation!r}::DOUBLE)")
    return ", ".join(rows)


def _channel(turn: str) -> str:
    at = f"(hue + {turn} - floor(hue + {turn}))"
    return f"""CAST(round_even(255 * CASE WHEN {at} < 1 / 6.0::DOUBLE THEN lower_ + (upper_ - lower_) * 6 * {at}
      WHEN {at} < 0.5 THEN upper_ WHEN {at} < 2 / 3.0::DOUBLE THEN lower_ + (upper_ - lower_) * (2 / 3.0::DOUBLE - {at}) * 6
      ELSE lower_ END, 0) AS INTEGER)"""


_MICRO_CODES = """mr AS (SELECT macro_cluster, row_number() OVER (ORDER BY sum(publications) DESC, macro_cluster) AS m
  FROM report_micro GROUP BY 1),
sheet AS (SELECT r.*, m AS macro_cluster_id,
    row_number() OVER (ORDER BY publications DESC, yearly_rank_citations DESC, micro_cluster) AS display_id,
    m || '-' || row_number() OVER (PARTITION BY macro_cluster ORDER BY publications DESC, micro_cluster) AS cluster_code
  FROM report_micro r JOIN mr USING (macro_cluster))"""


def _sheet(level: str) -> str:
    return (f"sheet AS (SELECT *, CAST(row_number() OVER (ORDER BY publications DESC, {level}_cluster) AS VARCHAR) "
            f"AS cluster_code FROM report_{level})")


def _stats(key: str, values: str, name: str, top: int) -> str:
    return f"""{name}_s AS (SELECT {key}, {name}, count(*) AS freq,
      {q.rounded('avg(publication_year)', 1)} AS avg_publication_year, {q.rounded('avg(citations)', 2)} AS avg_citation,
      row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {name} ASC NULLS LAST) AS rn
    FROM (SELECT {key}, publication_year, citations, unnest({values}) AS {name} FROM works) GROUP BY {key}, {name}
    QUALIFY rn <= {top})"""


_CLUSTERS = f"""{q.MICRO}, {COLORS}, {_NAMES},
{_stats('micro_cluster', 'countries', 'country', 1000)}, {_stats('micro_cluster', 'institutions', 'institution', 20)},
named_s AS (SELECT micro_cluster, freq, CASE WHEN r_name = 'ASIA' THEN country ELSE r_name || ' ' || country END AS country
  FROM country_s JOIN nation ON n_name = country JOIN region ON n_regionkey = r_regionkey
  QUALIFY row_number() OVER (PARTITION BY micro_cluster ORDER BY freq DESC,
    CASE WHEN r_name = 'ASIA' THEN country ELSE r_name || ' ' || country END) <= 20),
tt AS (SELECT micro_cluster, string_agg(CASE WHEN t = '' THEN ':' || c ELSE t || ':' || c END, '|' ORDER BY rn) AS top_titles
  FROM (SELECT micro_cluster, trim(coalesce(title, '')) AS t, coalesce(citations, 0) AS c, row_number() OVER (
    PARTITION BY micro_cluster ORDER BY citations DESC NULLS LAST, id) AS rn FROM works) WHERE rn <= 10 GROUP BY 1),
cc AS (SELECT micro_cluster, string_agg(country || ':' || freq, '|' ORDER BY freq DESC, country) AS countries
  FROM named_s GROUP BY 1),
ii AS (SELECT micro_cluster, string_agg(institution || ':' || freq, '|' ORDER BY freq DESC, institution) AS institutions
  FROM institution_s GROUP BY 1),
clusters AS (SELECT row_number() OVER (ORDER BY publications DESC, yearly_rank_citations DESC, r.micro_cluster) AS display_id,
    r.micro_cluster AS global_id,
    coalesce(g.short_name, CASE WHEN c_nationkey = 3 THEN 'Cluster ' || r.micro_cluster
      ELSE upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' Deep-Sea Mining' END) AS short_name,
    coalesce(g.name, CASE WHEN c_nationkey = 3 THEN 'Cluster ' || r.micro_cluster
      ELSE upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' Deep-Sea Mining' END) AS name,
    coalesce(g.description, '') AS description, publications, ave_py, yearly_rank_citations, japan_count AS japan,
    r.macro_cluster, CASE WHEN r_name = 'ASIA' THEN 'Unknown' ELSE r_name END AS macro_cluster_label,
    color_hex AS macro_color, top_titles, countries, institutions
  FROM report_micro r JOIN customer ON c_custkey = r.micro_cluster LEFT JOIN given g USING (micro_cluster)
  JOIN region ON r_regionkey = r.macro_cluster JOIN colors USING (macro_cluster)
  LEFT JOIN tt USING (micro_cluster) LEFT JOIN cc USING (micro_cluster) LEFT JOIN ii USING (micro_cluster))"""

SQL = {
    **{f"bars_table_{level}": _bars_sql(level) for level in ("micro", "meso", "macro")},
    **{f"scatter_table_{level}": _scatter_sql(level) for level in ("micro", "meso", "macro")},
    "label_anchors": f"""WITH {_POINTS} SELECT cluster, median(x) AS cx, median(y) AS cy, count(*) AS n_docs
      FROM pts GROUP BY 1 HAVING count(*) >= 20""",
    "map_layers": f"""WITH {q.MICRO}, {_POINTS},
      rows_ AS (SELECT 'micro' AS layer, id AS cluster, x, y, macro_cluster, CAST(1 AS BIGINT) AS size
          FROM pts LEFT JOIN report_micro ON micro_cluster = id
        UNION ALL SELECT 'meso', id, x, y, ma, n FROM pts JOIN (SELECT meso_cluster, min(macro_cluster) AS ma,
          count(DISTINCT micro_cluster) AS n FROM report_micro GROUP BY 1) ON meso_cluster = id
        UNION ALL SELECT 'macro', id, x, y, macro_cluster, n FROM pts JOIN (SELECT macro_cluster,
          count(DISTINCT micro_cluster) AS n FROM report_micro GROUP BY 1) ON macro_cluster = id),
      span AS (SELECT *, sqrt(min(size) OVER (PARTITION BY layer)) AS lo, sqrt(max(size) OVER (PARTITION BY layer)) AS hi FROM rows_)
      SELECT layer, cluster, x, y, macro_cluster, size, {q.rounded(
        'CASE WHEN hi = lo THEN 210.0 ELSE 20.0 + 380.0 * (sqrt(size) - lo) / (hi - lo) END', 4)} AS marker FROM span""",
    "labelled_points": f"""WITH {_POINTS} SELECT id, cluster, x, y,
        CASE WHEN cluster < 5 THEN cluster || '-0---' ELSE CAST(cluster AS VARCHAR) END AS cluster_code,
        CAST(cluster AS VARCHAR) AS main_cluster,
        CASE WHEN r_name IS NULL THEN CAST(cluster AS VARCHAR) ELSE cluster || '-0. ' || r_name END AS label,
        cluster < 5 AS matched
      FROM documents JOIN pts ON id = doc_id LEFT JOIN region ON r_regionkey = cluster""",
    "facet_frequency": f"""WITH v AS (SELECT unnest([o_orderpriority, c_mktsegment]) AS raw
        FROM orders JOIN customer ON o_custkey = c_custkey)
      SELECT item, item[1:45] AS label, count(*) AS documents
      FROM (SELECT {q.title_cased('lower(raw)')} AS item FROM v) GROUP BY 1, 2""",
    "yearly_counts": f"""WITH {q.WORKS} SELECT CAST(publication_year AS BIGINT) AS year, count(*) AS documents
      FROM works GROUP BY 1""",
    "recent_years": f"""WITH {q.WORKS} SELECT CAST(publication_year AS BIGINT) AS year, count(*) AS documents
      FROM works GROUP BY 1 ORDER BY 1 DESC LIMIT 5""",
    "cluster_labels": f"""WITH {_CODES} SELECT cluster_code, replace(replace(cluster_code, '---', ''), '-0', '') AS cleaned,
      CAST(r AS VARCHAR) AS main_cluster,
      substring(CASE WHEN coalesce(gn, cn) IS NULL THEN shown ELSE shown || '. ' || coalesce(gn, cn) END, 1, 35) AS label
      FROM (SELECT *, regexp_replace(regexp_replace(cluster_code, '-0$', ''), '---$', '') AS shown FROM codes)""",
    "color_ramp": f"""WITH {_CODES}, {_SHOWN}
      SELECT cluster_code, CAST(r AS VARCHAR) AS main_cluster,
        coalesce(['{PALETTE[0]}', '{PALETTE[1]}', '{PALETTE[2]}'][g], '#d3d3d3') AS color,
        CASE WHEN g <= 3 AND c > 1 THEN {q.rounded('0.30 + 0.40 * (rn - 1) / CAST(c - 1 AS DOUBLE)', 6)} END AS lightness FROM n""",
    "color_shades": f"""WITH {_CODES}, {_SHOWN}, p(place, color, hue, sat) AS (VALUES {_palette_rows()}),
      l AS (SELECT n.*, color, hue, sat, g = max(g) OVER () AS last_, 0.3::DOUBLE + (0.7::DOUBLE - 0.3::DOUBLE) * (rn - 1) / greatest(c - 1, 1) AS light
        FROM n JOIN p ON place = (g - 1) % {len(PALETTE)}),
      u AS (SELECT *, CASE WHEN light <= 0.5 THEN light * (1 + sat) ELSE light + sat - light * sat END AS upper_,
        2 * light - CASE WHEN light <= 0.5 THEN light * (1 + sat) ELSE light + sat - light * sat END AS lower_ FROM l)
      SELECT cluster_code, CASE WHEN last_ THEN '#d3d3d3' ELSE color END AS color,
        CASE WHEN last_ THEN '#d3d3d3' WHEN c <= 1 THEN color ELSE format('#{{:02x}}{{:02x}}{{:02x}}',
          {_channel('1 / 3.0::DOUBLE')}, {_channel('0')}, {_channel('-1 / 3.0::DOUBLE')}) END AS sub_color FROM u""",
    "plot_clusters": """SELECT p_size || '-' || p_partkey AS cluster_code, p_partkey % 30 AS documents FROM part
      WHERE (p_size || '-' || p_partkey) NOT LIKE '%-99%' AND p_partkey % 30 >= 10""",
    "cluster_sheet": f"""WITH {q.MICRO}, {_MICRO_CODES}, {_NAMES}
      SELECT display_id, cluster_code, micro_cluster, coalesce(short_name, '') AS short_name, coalesce(name, '') AS name,
        coalesce(description, '') AS description, publications, macro_cluster_id
      FROM sheet LEFT JOIN given USING (micro_cluster)""",
    "article_pack": f"""WITH {q.WORKS}, {q.report('meso')}, {_sheet('meso')},
      top AS (SELECT *, row_number() OVER (PARTITION BY meso_cluster ORDER BY citations DESC NULLS LAST, id) AS rn FROM works)
      SELECT cluster_code, t.id AS article_id, title, trim(coalesce(d.text, '')) AS abstract,
        CAST(publication_year AS BIGINT) AS year, citations AS citation,
        coalesce(d.lang || '; x', '') AS authors, coalesce(d.source, '') AS publication_source, t.meso_cluster
      FROM top t LEFT JOIN documents d ON 'W' || d.doc_id = t.id JOIN sheet s USING (meso_cluster) WHERE rn <= 20""",
    "country_pack": f"""WITH {q.WORKS}, {q.report('meso')}, {_sheet('meso')},
      {_stats('meso_cluster', 'countries', 'country', 10)}
      SELECT cluster_code, CASE WHEN r_name = 'ASIA' THEN country ELSE r_name || ' ' || country END AS country,
        freq, avg_publication_year, avg_citation
      FROM country_s JOIN sheet USING (meso_cluster) JOIN nation ON n_name = country JOIN region ON n_regionkey = r_regionkey""",
    "institution_pack": f"""WITH {q.WORKS}, {q.report('macro')}, {_sheet('macro')},
      {_stats('macro_cluster', 'institutions', 'institution', 100)}
      SELECT cluster_code, institution, freq, avg_publication_year, avg_citation
      FROM institution_s JOIN sheet USING (macro_cluster)""",
    "level_info": f"""WITH {q.WORKS}, {q.report('meso')},
      t AS (SELECT CAST(CAST(sum(publications) AS BIGINT) AS VARCHAR) AS d, CAST(count(*) AS VARCHAR) AS c FROM report_meso)
      SELECT 'data' AS item, 'snapshot_2026-06-26' AS value UNION ALL SELECT 'query', 'orders'
      UNION ALL SELECT 'subquery', 'all' UNION ALL SELECT 'level', 'meso'
      UNION ALL SELECT 'documents', d FROM t UNION ALL SELECT 'clusters', c FROM t""",
    "report_payload": f"""WITH {_CLUSTERS} SELECT display_id, global_id, short_name, name, description, publications, japan,
      macro_cluster_label, macro_color, top_titles, countries, institutions FROM clusters""",
    "report_totals": f"""WITH {_CLUSTERS} SELECT CAST(sum(publications) AS BIGINT) AS total_publications,
      count(*) AS total_clusters, count(DISTINCT macro_cluster) AS total_macro_clusters FROM clusters""",
    "scatter_series": f"""WITH {_CLUSTERS} SELECT macro_cluster_label AS series, macro_color AS color, ave_py AS x,
      yearly_rank_citations AS y, publications AS size, display_id || '-' || short_name AS text,
      row_number() OVER (PARTITION BY macro_cluster_label ORDER BY display_id) AS point FROM clusters""",
}
