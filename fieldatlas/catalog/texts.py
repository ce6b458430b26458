"""Keywords, vectors, naming and enriched texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas import derive
from fieldatlas.catalog import fragments as q
from fieldatlas.catalog.reports import all_reports, report
from fieldatlas.functions import text
from fieldatlas.functions.numbers import round_to
from fieldatlas.operators import sampling, vectors
from fieldatlas.plans import enriched, keywords, naming
from fieldatlas.session import Scratch

STOP_WORDS = ("the", "an", "of", "in", "and", "to", "on", "that", "de", "la", "le", "et")
SAMPLE, SEED = 3000, 42


# --- keywords ----------------------------------------------------------------

def _doc_keywords(label: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return keywords.class_keywords(derive.table(spark, folder, "documents"), label, "text",
                                       Scratch(spark), stop_words=STOP_WORDS)
    return query


def title_keywords(spark: SparkSession, folder: str, level: str) -> DataFrame:
    """Keywords from the titles of a level's works."""
    return keywords.class_keywords(derive.works(spark, folder), f"{level}_cluster", "title",
                                   Scratch(spark), stop_words=())


# --- vectors -------------------------------------------------------------------

def _points(spark: SparkSession, folder: str) -> DataFrame:
    return derive.table(spark, folder, "embeddings").select(
        "vec_id", "embedding", F.col("label").cast("bigint").alias("label"),
        (F.col("vec_id") % 7 + 1).alias("weight"))


def _long(df: DataFrame, key: str) -> DataFrame:
    """One row per vector entry, for value comparison."""
    return df.select(key, F.posexplode("embedding").alias("dim", "value")).select(
        key, F.col("dim").cast("bigint").alias("dim"), round_to(F.col("value"), 4).alias("value"))


def _rolled_up(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    micro = vectors.centroids(points, "label").withColumnRenamed("label", "micro_cluster")
    meta = points.groupBy(F.col("label").alias("micro_cluster")).agg(F.count(F.lit(1)).alias("rep_count")) \
        .withColumns({"macro_cluster": F.floor(F.col("micro_cluster") / 5),
                      "publications": F.when(F.col("micro_cluster") % 3 != 0, F.col("micro_cluster") * 10)})
    return _long(vectors.rolled_up(micro, meta, "macro"), "macro_cluster")


def _projection(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    axes = vectors.plane_axes(points)
    micro = vectors.on_plane(points.select("vec_id", "embedding"), axes)
    macro = vectors.on_plane(vectors.centroids(points, "label"), axes)
    return micro.select(F.lit("micro").alias("layer"), F.col("vec_id").alias("cluster"), "x_coords", "y_coords") \
        .unionByName(macro.select(F.lit("label").alias("layer"), F.col("label").alias("cluster"),
                                  "x_coords", "y_coords"))


# --- naming ----------------------------------------------------------------------

def _titles(spark: SparkSession, folder: str) -> DataFrame:
    found = naming.top_titles(derive.works(spark, folder))
    return found.select("macro_cluster", F.array_join("titles", "|").alias("titles"))


def _context(spark: SparkSession, folder: str) -> DataFrame:
    return naming.child_context(report(spark, folder, "meso"), title_keywords(spark, folder, "meso"))


def _macro_inputs(spark: SparkSession, folder: str) -> DataFrame:
    reports = all_reports(spark, folder)
    context = naming.child_context(reports["meso"], title_keywords(spark, folder, "meso"))
    return naming.macro_inputs(reports["macro"], title_keywords(spark, folder, "macro"), context)


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    inputs = naming.micro_inputs(
        derive.table(spark, folder, "customer").select(F.col("c_custkey").alias("micro_cluster")),
        derive.table(spark, folder, "customer").select(F.col("c_custkey").alias("cluster"),
                                                       F.lower("c_mktsegment").alias("keywords")),
        derive.works(spark, folder))
    return naming.request_rows(inputs)


def _batches(spark: SparkSession, folder: str) -> DataFrame:
    ids = derive.table(spark, folder, "customer").select(F.col("c_custkey").alias("micro_cluster"))
    return naming.batches(ids, "micro_cluster", Scratch(spark))


def _macro_requests(spark: SparkSession, folder: str) -> DataFrame:
    sizes = derive.table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("macro_cluster")) \
                  .agg(F.count(F.lit(1)).alias("publications"))
    return naming.macro_requests(sizes, Scratch(spark))


def _raw_names(spark: SparkSession, folder: str) -> DataFrame:
    """Market segment of every customer as the answer for its nation; most collide."""
    return derive.table(spark, folder, "customer").select(
        F.col("c_nationkey").cast("bigint").alias("macro_cluster"),
        F.initcap(F.lower("c_mktsegment")).alias("name"),
        F.when(F.col("c_acctbal") > 0, F.lower("c_mktsegment")).alias("description"),
        F.col("c_custkey").alias("position"))


def _nation_works(spark: SparkSession, folder: str) -> DataFrame:
    return derive.works(spark, folder).select(F.col("meso_cluster").alias("macro_cluster"), "title", "citations")


def _final_names(spark: SparkSession, folder: str) -> DataFrame:
    works = _nation_works(spark, folder)
    expected = works.select("macro_cluster").unionAll(
        derive.table(spark, folder, "region").select((F.col("r_regionkey") + 100).cast("bigint")))
    return naming.final_names(_raw_names(spark, folder), expected, naming.top_titles(works), Scratch(spark))


def _coverage(spark: SparkSession, folder: str) -> DataFrame:
    expected = derive.table(spark, folder, "orders").select(F.col("o_custkey").alias("micro_cluster"))
    found = derive.table(spark, folder, "part").select(F.col("p_partkey").alias("micro_cluster"))
    return naming.coverage(expected, found, "micro_cluster")


def _answers(spark: SparkSession, folder: str) -> DataFrame:
    customers = derive.table(spark, folder, "customer")
    answer = F.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("short_name"),
                                F.col("c_name").alias("description")))
    return naming.parse_answers(customers.select(
        F.concat(F.lit("micro-"), F.col("c_custkey").cast("string")).alias("custom_id"),
        F.when(F.col("c_acctbal") >= 0, answer).otherwise(F.lit("no json")).alias("content"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("no")).alias("refusal")))


def _fallback_titles(spark: SparkSession, folder: str) -> DataFrame:
    parts = derive.table(spark, folder, "part")
    listed = F.concat_ws(", ", "p_name", F.lower("p_type"), F.lower("p_brand"))
    return parts.select("p_partkey", text.keyword_title(listed, 2).alias("title"),
                        text.first_keywords(listed, 2).alias("short"))


# --- enriched texts ----------------------------------------------------------------

def macro_names(spark: SparkSession, folder: str) -> DataFrame:
    """Region names; one is left out so that its default shows."""
    return derive.table(spark, folder, "region").select(
        F.col("r_regionkey").cast("bigint").alias("macro_cluster"), F.col("r_name").alias("name")) \
        .where("name <> 'ASIA'")


def macro_colors(spark: SparkSession, folder: str) -> DataFrame:
    return naming.macro_colors(derive.works(spark, folder))


def _abstract_source(spark: SparkSession, folder: str) -> DataFrame:
    return derive.document_nodes(spark, folder).select("id", "abstract")


def _backfilled(spark: SparkSession, folder: str) -> DataFrame:
    works = derive.works(spark, folder).select("id", "title", "abstract")
    return enriched.backfill(works, [_abstract_source(spark, folder)])


def _backfill_counts(spark: SparkSession, folder: str) -> DataFrame:
    return enriched.backfill_counts(derive.works(spark, folder), _backfilled(spark, folder))


def _records(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    works = derive.works(spark, folder)
    size = derive.table(spark, folder, "region").select(
        F.col("r_regionkey").cast("bigint").alias("macro_cluster"), F.lit(7).alias("publications"))
    return enriched.records(works, report(spark, folder, "micro"), macro_names(spark, folder), macro_colors(spark, folder), size,
                            Scratch(spark), [_abstract_source(spark, folder)], limit=SAMPLE, seed=SEED)


def _allocation(spark: SparkSession, folder: str) -> DataFrame:
    sizes = derive.works(spark, folder).groupBy("micro_cluster").agg(F.count(F.lit(1)).alias("n_docs"))
    strata, rows = sizes.agg(F.count(F.lit(1)), F.sum("n_docs")).first()
    return sampling.allocate(sizes, "micro_cluster", (strata + rows) // 2, Scratch(spark))


def _keyword_texts(spark: SparkSession, folder: str) -> DataFrame:
    return enriched.keyword_texts(derive.works(spark, folder), title_keywords(spark, folder, "meso"),
                                  title_keywords(spark, folder, "macro"))


def _prefixed(spark: SparkSession, folder: str) -> DataFrame:
    docs = derive.table(spark, folder, "documents")
    labels = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("parent_code"),
                         F.col("source").alias("child_code"))
    texts = docs.select(F.col("doc_id").alias("id"), F.substring_index("text", ".", 1).alias("title"),
                        F.col("text").alias("abstract"))
    parents = docs.where("lang <> 'de'").select(F.col("lang").alias("code"), F.upper("lang").alias("name")).distinct()
    kids = docs.where("source <> 'src3'").select(F.col("source").alias("code"),
                                                 F.concat(F.lit("Source "), F.col("source")).alias("name")).distinct()
    return enriched.prefixed_texts(labels, texts, parents, kids)


QUERIES = {
    "class_keywords_source": _doc_keywords("source"),
    "class_keywords_lang": _doc_keywords("lang"),
    "title_keywords_meso": lambda s, d: title_keywords(s, d, "meso"),
    "centroids": lambda s, d: _long(vectors.centroids(_points(s, d), "label"), "label"),
    "weighted_centroids": lambda s, d: _long(vectors.centroids(_points(s, d), "label", weight="weight"), "label"),
    "rolled_up_centroids": _rolled_up,
    "unit_vectors": lambda s, d: _long(_points(s, d).select("vec_id", vectors.unit(F.col("embedding"))
                                                            .alias("embedding")), "vec_id"),
    "projection_2d": _projection,
    "document_embeddings": lambda s, d: vectors.hashed_embeddings(
        derive.table(s, d, "documents"), "doc_id", "text", 128),
    "macro_palette": macro_colors,
    "top_titles": _titles,
    "child_context": _context,
    "naming_context": _macro_inputs,
    "naming_requests": _requests,
    "naming_batches": _batches,
    "naming_macro_requests": _macro_requests,
    "name_coverage": _coverage,
    "name_finalise": _final_names,
    "label_parse": _answers,
    "keyword_titles": _fallback_titles,
    "abstract_backfill": _backfilled,
    "abstract_backfill_counts": _backfill_counts,
    "macro_display": lambda s, d: _records(s, d)[1],
    "stratified_sample": lambda s, d: _records(s, d)[0],
    "sample_allocation": _allocation,
    "keyword_texts": _keyword_texts,
    "prefixed_texts": _prefixed,
}

# --- plain SQL ------------------------------------------------------------------------

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def _keywords_sql(source: str, label: str, column: str, stop: str, name: str = "kw") -> str:
    kept = f"list_filter({{}}, lambda t: t NOT IN ({stop}))" if stop else "{}"
    words = kept.format(f"regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{N}}_]{{2,}}')")
    return f"""{name}_w AS (SELECT {label} AS cluster, {words} AS w FROM {source}
    WHERE {label} IS NOT NULL AND {column} IS NOT NULL),
{name}_t AS (SELECT cluster, unnest(w) AS term FROM {name}_w
  UNION ALL SELECT cluster, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM {name}_w
    WHERE len(w) > 1),
{name}_c AS (SELECT cluster, term, count(*) AS n FROM {name}_t GROUP BY 1, 2),
{name}_v AS (SELECT term, sum(n) AS total FROM {name}_c GROUP BY 1),
{name}_k AS (SELECT cluster, term, n, total FROM {name}_c JOIN {name}_v USING (term)),
{name}_s AS (SELECT cluster, sum(n) AS size FROM {name}_k GROUP BY 1),
{name}_r AS (SELECT cluster, term, row_number() OVER (PARTITION BY cluster ORDER BY round(
    sqrt(n / CAST(size AS DOUBLE)) * ln(1.0 + (SELECT floor(avg(size)) FROM {name}_s) / CAST(total AS DOUBLE)), 9) DESC,
    term) AS rank FROM {name}_k JOIN {name}_s USING (cluster)),
{name} AS (SELECT cluster, string_agg(term, ', ' ORDER BY rank) AS keywords FROM {name}_r WHERE rank <= 10 GROUP BY 1)"""


_ENTRIES = """entries AS (SELECT vec_id, CAST(label AS BIGINT) AS label, vec_id % 7 + 1 AS weight,
  unnest(range(0, len(embedding))) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"""


def _centroid_sql(weight: str) -> str:
    return f"""m AS (SELECT label, dim, sum(x * {weight}) / sum({weight}) AS x FROM entries GROUP BY 1, 2),
u AS (SELECT label, dim, x / sqrt(sum(x * x) OVER (PARTITION BY label)) AS x FROM m)"""


_COLOR = """palette AS (SELECT DISTINCT macro_cluster, (macro_cluster * 0.6180339887498949::DOUBLE) % 1.0::DOUBLE AS h FROM works),
hsv AS (SELECT macro_cluster, CAST(floor(h * 6) AS INTEGER) AS i, h * 6 - floor(h * 6) AS f,
  0.85::DOUBLE AS v, (0.85::DOUBLE * (1.0::DOUBLE - 0.62::DOUBLE)) AS p FROM palette),
pq AS (SELECT *, v * (1.0 - 0.62::DOUBLE * f) AS q, v * (1.0 - 0.62::DOUBLE * (1.0 - f)) AS t FROM hsv),
rgb AS (SELECT macro_cluster, [[v, t, p], [q, v, p], [p, v, t], [p, q, v], [t, p, v], [v, p, q]][i + 1] AS c FROM pq),
colors AS (SELECT macro_cluster, '#' || lower(lpad(to_hex(CAST(floor(c[1] * 255) AS INTEGER)), 2, '0')
  || lpad(to_hex(CAST(floor(c[2] * 255) AS INTEGER)), 2, '0')
  || lpad(to_hex(CAST(floor(c[3] * 255) AS INTEGER)), 2, '0')) AS color_hex FROM rgb)"""
COLORS = _COLOR

_TITLES = """titled AS (SELECT {key} AS macro_cluster, trim(title) AS title, row_number() OVER (
    PARTITION BY {key} ORDER BY citations DESC NULLS LAST, trim(title)) AS rn
  FROM works WHERE {key} IS NOT NULL AND trim(title) <> '')"""
_CONTEXT = """children AS (SELECT macro_cluster, keywords, row_number() OVER (
    PARTITION BY macro_cluster ORDER BY publications DESC, meso_cluster) AS rn
  FROM report_meso LEFT JOIN kw_meso ON cluster = meso_cluster),
ctx AS (SELECT macro_cluster, string_agg(trim(keywords), ' | ' ORDER BY rn) AS context FROM children
  WHERE rn <= 4 AND trim(keywords) <> '' GROUP BY 1)"""
_MESO_KW = _keywords_sql("works", "meso_cluster", "title", "", "kw_meso")
_MACRO_KW = _keywords_sql("works", "macro_cluster", "title", "", "kw_macro")
_FILLED = """filled AS (SELECT w.* REPLACE (d.text AS abstract) FROM works w
  LEFT JOIN (SELECT 'W' || doc_id AS id, text FROM documents WHERE trim(text) <> '') d USING (id))"""
_DISPLAY = """names AS (SELECT CAST(r_regionkey AS BIGINT) AS macro_cluster, r_name AS name FROM region WHERE r_name <> 'ASIA'),
shown AS (SELECT macro_cluster, count(*) AS subquery_documents,
    row_number() OVER (ORDER BY count(*) DESC, macro_cluster) AS display_id FROM works GROUP BY 1),
display AS (SELECT macro_cluster, subquery_documents, display_id,
    coalesce(name, 'Macro ' || macro_cluster) AS macro_name, color_hex, CAST(7 AS BIGINT) AS macro_publications_global
  FROM shown LEFT JOIN names USING (macro_cluster) JOIN colors USING (macro_cluster))"""


def _allocation_sql(sizes: str, key: str, limit: str) -> str:
    return f"""sz AS ({sizes}), tot AS (SELECT sum(n_docs) AS n, count(*) AS g FROM sz),
lim AS (SELECT CAST({limit} AS BIGINT) AS cap, CAST(n AS BIGINT) AS n, g FROM tot),
part AS (SELECT {key}, n_docs, ((cap - g) * (n_docs - 1)) // (n - g) AS whole,
    ((cap - g) * (n_docs - 1)) % (n - g) AS rest, cap - g AS seats FROM sz, lim),
seat AS (SELECT {key}, n_docs, 1 + whole + CASE WHEN row_number() OVER (ORDER BY n_docs > 1 DESC, rest DESC,
    n_docs DESC, {key}) <= seats - sum(whole) OVER () AND n_docs > 1 THEN 1 ELSE 0 END AS take FROM part)"""


_NAMES_SQL = f"""WITH {q.WORKS}, {_TITLES.format(key='meso_cluster')},
raw AS (SELECT CAST(c_nationkey AS BIGINT) AS macro_cluster, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS name,
    CASE WHEN c_acctbal > 0 THEN lower(c_mktsegment) END AS description,
    row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer),
wanted AS (SELECT DISTINCT meso_cluster AS macro_cluster FROM works UNION SELECT r_regionkey + 100 FROM region),
lists AS (SELECT macro_cluster, list(title ORDER BY rn) AS titles FROM titled WHERE rn <= 50 GROUP BY 1),
base AS (SELECT w.macro_cluster, coalesce(r.name, 'Macro Topic ' || w.macro_cluster) AS name,
    coalesce(r.description, CASE WHEN titles IS NULL
      THEN 'Field of cluster ' || w.macro_cluster || ' without titled works.'
      ELSE 'Field around the works: ' || array_to_string(titles[1:3], '; ') || '.' END) AS description
  FROM wanted w LEFT JOIN (SELECT * FROM raw WHERE rn = 1) r USING (macro_cluster) LEFT JOIN lists USING (macro_cluster))
SELECT CAST(macro_cluster AS BIGINT) AS macro_cluster, CASE WHEN macro_cluster = min(macro_cluster) OVER (
    PARTITION BY lower(name)) THEN name ELSE name || ' (' || macro_cluster || ')' END AS name, description FROM base"""

_RECORD = """told AS (SELECT id AS paper_id, micro_cluster, f.macro_cluster, display_id, macro_name, color_hex, title,
    macro_name || CASE WHEN trim(concat_ws(' ', nullif(trim(title), ''), trim(abstract))) <> ''
      THEN '. ' || trim(concat_ws(' ', nullif(trim(title), ''), trim(abstract))) ELSE '' END AS text_enriched,
    trim(abstract) AS abstract
  FROM filled f JOIN display USING (macro_cluster))"""

SQL = {
    "class_keywords_source": "WITH " + _keywords_sql("documents", "source", "text", _STOP) + " SELECT * FROM kw",
    "class_keywords_lang": "WITH " + _keywords_sql("documents", "lang", "text", _STOP) + " SELECT * FROM kw",
    "title_keywords_meso": f"WITH {q.WORKS}, {_MESO_KW} SELECT * FROM kw_meso",
    "centroids": f"WITH {_ENTRIES}, {_centroid_sql('1')} SELECT label, dim, {q.rounded('x', 4)} AS value FROM u",
    "weighted_centroids": f"WITH {_ENTRIES}, {_centroid_sql('weight')} SELECT label, dim, {q.rounded('x', 4)} AS value FROM u",
    "rolled_up_centroids": f"""WITH {_ENTRIES}, {_centroid_sql('1')},
      reps AS (SELECT CAST(label AS BIGINT) AS label, count(*) AS n FROM embeddings GROUP BY 1),
      ww AS (SELECT label, label // 5 AS macro_cluster, CASE WHEN label % 3 <> 0 THEN label * 10 ELSE n END AS w FROM reps),
      mm AS (SELECT macro_cluster, dim, sum(x * w) / sum(w) AS x FROM u JOIN ww USING (label) GROUP BY 1, 2),
      uu AS (SELECT macro_cluster, dim, x / sqrt(sum(x * x) OVER (PARTITION BY macro_cluster)) AS x FROM mm)
      SELECT macro_cluster, dim, {q.rounded('x', 4)} AS value FROM uu""",
    "unit_vectors": f"""WITH {_ENTRIES} SELECT vec_id, dim,
      {q.rounded('x / sqrt(sum(x * x) OVER (PARTITION BY vec_id))', 4)} AS value FROM entries""",
    "macro_palette": f"WITH {q.WORKS}, {_COLOR} SELECT macro_cluster, color_hex FROM colors",
    "top_titles": f"""WITH {q.WORKS}, {_TITLES.format(key='macro_cluster')}
      SELECT macro_cluster, string_agg(title, '|' ORDER BY rn) AS titles FROM titled WHERE rn <= 50 GROUP BY 1""",
    "child_context": f"""WITH {q.WORKS}, {q.report('meso')}, {_MESO_KW}, {_CONTEXT} SELECT * FROM ctx""",
    "naming_context": f"""WITH {q.REPORTS}, {_MESO_KW}, {_MACRO_KW}, {_CONTEXT}
      SELECT macro_cluster, publications, coalesce(keywords, '') AS macro_keywords, coalesce(context, '') AS meso_context
      FROM report_macro LEFT JOIN kw_macro ON cluster = macro_cluster LEFT JOIN ctx USING (macro_cluster)""",
    "naming_requests": f"""WITH {q.WORKS},
      t AS (SELECT micro_cluster, title, row_number() OVER (PARTITION BY micro_cluster
        ORDER BY citations DESC NULLS LAST, id) AS rn FROM works WHERE title IS NOT NULL),
      l AS (SELECT micro_cluster, string_agg(rn || '. ' || title, chr(10) ORDER BY rn) AS listed FROM t WHERE rn <= 10 GROUP BY 1)
      SELECT 'micro-' || c_custkey AS custom_id, 'Terms that set this cluster apart:' || chr(10)
        || lower(c_mktsegment) || chr(10) || chr(10) || 'Its most cited works:' || chr(10)
        || coalesce(listed, '') AS prompt
      FROM customer LEFT JOIN l ON micro_cluster = c_custkey""",
    "naming_batches": """SELECT c_custkey AS micro_cluster, (row_number() OVER (ORDER BY c_custkey) - 1) // 8 AS batch
      FROM customer""",
    "naming_macro_requests": """WITH s AS (SELECT o_custkey, count(*) AS n,
        (row_number() OVER (ORDER BY o_custkey) - 1) // 8 AS batch FROM orders GROUP BY 1)
      SELECT batch, '[' || string_agg('{"macro_cluster":' || o_custkey || ',"publications":' || n || '}', ','
        ORDER BY o_custkey) || ']' AS clusters FROM s GROUP BY 1""",
    "name_coverage": """SELECT DISTINCT o_custkey AS micro_cluster, 'missing' AS status FROM orders
        WHERE o_custkey NOT IN (SELECT p_partkey FROM part)
      UNION ALL SELECT DISTINCT p_partkey, 'unexpected' FROM part WHERE p_partkey NOT IN (SELECT o_custkey FROM orders)""",
    "name_finalise": _NAMES_SQL,
    "label_parse": """SELECT c_custkey AS micro_cluster,
        CASE WHEN ok THEN c_name END AS name, CASE WHEN ok THEN c_mktsegment END AS short_name,
        CASE WHEN ok THEN c_name END AS description,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN 'refusal: no' WHEN NOT ok THEN 'parse: no complete answer' END AS error
      FROM (SELECT *, c_acctbal >= 0 AND c_mktsegment <> 'MACHINERY' AS ok FROM customer)""",
    "keyword_titles": f"""SELECT p_partkey,
        {q.title_cased("p_name || ' ' || lower(p_type)")} AS title,
        p_name || ', ' || lower(p_type) AS short FROM part""",
    "abstract_backfill": f"WITH {q.WORKS}, {_FILLED} SELECT id, title, trim(abstract) AS abstract FROM filled",
    "abstract_backfill_counts": f"""WITH {q.WORKS}, {_FILLED} SELECT count(*) AS rows_before,
      CAST(0 AS BIGINT) AS filled_before, count(*) AS rows_after, count(abstract) AS filled_after FROM filled""",
    "macro_display": f"WITH {q.WORKS}, {_COLOR}, {_DISPLAY} SELECT * FROM display",
    "stratified_sample": f"""WITH {q.WORKS}, {_COLOR}, {_DISPLAY}, {_FILLED}, {_RECORD},
      {_allocation_sql('SELECT macro_cluster, count(*) AS n_docs FROM told GROUP BY 1', 'macro_cluster', str(SAMPLE))},
      dice AS (SELECT *, row_number() OVER (PARTITION BY macro_cluster ORDER BY md5('{SEED}:' || paper_id), paper_id) AS rn FROM told)
      SELECT dice.* EXCLUDE (rn) FROM dice JOIN seat USING (macro_cluster) WHERE rn <= take""",
    "sample_allocation": f"""WITH {q.WORKS}, {_allocation_sql(
        'SELECT micro_cluster, count(*) AS n_docs FROM works GROUP BY 1', 'micro_cluster', '(n + g) // 2')}
      SELECT micro_cluster, n_docs, CAST(take AS BIGINT) AS take FROM seat""",
    "keyword_texts": f"""WITH {q.WORKS}, {_MESO_KW}, {_MACRO_KW} SELECT id, trim(coalesce(title, '') || '. '
        || repeat(coalesce(a.keywords, '') || '. ' || coalesce(b.keywords, '') || '. ', 2)) AS text
      FROM works LEFT JOIN kw_meso a ON a.cluster = meso_cluster LEFT JOIN kw_macro b ON b.cluster = macro_cluster""",
    "prefixed_texts": """SELECT doc_id AS id, trim(CASE WHEN lang <> 'de' THEN upper(lang) || '. ' ELSE '' END
        || 'Source ' || source || '. ' || trim(split_part(text, '.', 1)) || ' ' || trim(text)) AS text
      FROM documents WHERE source <> 'src3'""",
}
