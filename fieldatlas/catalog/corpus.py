"""Ingest of raw works and topical subsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas import derive
from fieldatlas.functions import text
from fieldatlas.functions.numbers import as_number
from fieldatlas.plans import ingest, subset
from fieldatlas.session import Scratch
from fieldatlas.sources.readers import read_works


def _works(spark: SparkSession, folder: str) -> DataFrame:
    """Raw works written as JSON lines and read back."""
    return read_works(spark, Scratch(spark).save_lines(derive.raw_work_lines(spark, folder)))


def _nodes(spark: SparkSession, folder: str) -> DataFrame:
    found = ingest.nodes(_works(spark, folder), derive.WORK_PREFIX)
    lists = ("countries", "institutions", "institutions_ror", "institutions_type", "authors")
    return found.withColumns({c: text.joined_names(F.col(c), "|") for c in lists})


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.edges(_works(spark, folder), derive.WORK_PREFIX)


def _props(spark: SparkSession, folder: str) -> DataFrame:
    events = derive.table(spark, folder, "events")
    parsed = events.withColumn("p", F.from_json("props", "k string"))
    return parsed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("p.k").try_cast("bigint")).alias("k_total"),
        F.max(as_number(F.col("p.k"))).alias("k_max"))


def _subset(topic: subset.Topic):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return subset.nodes_query(derive.document_nodes(spark, folder), topic) \
                     .select("id", "title", "language", "citations", "publication_year")
    return query


_WORDS = {
    # patterns that occur in the test prose
    "regex_title": ("title", r"thereou|ionsh|hetion"),
    "word_boundary": ("title", r"\b(the|an|in)\b"),
    "title_abstract": ("text", r"\bthere"),
}
_TOPICS = {
    "subset_base": subset.Topic("base"),
    "subset_regex_title": subset.Topic("t", lambda: subset.title_matches(_WORDS["regex_title"][1])),
    "subset_word_boundary": subset.Topic("t", lambda: subset.title_matches(_WORDS["word_boundary"][1])),
    "subset_title_abstract": subset.Topic("t", lambda: subset.text_matches(_WORDS["title_abstract"][1])),
    "subset_two_regex": subset.Topic("t", lambda: subset.text_matches(_WORDS["regex_title"][1])
                                     & subset.text_matches(_WORDS["title_abstract"][1])),
    "subset_like": subset.Topic("t", lambda: subset.title_contains("er")),
}


def _sql_subset(spark: SparkSession, folder: str) -> DataFrame:
    return subset.sql_subset(
        derive.document_nodes(spark, folder),
        "SELECT id, citations FROM nodes_snapshot WHERE language = :language AND citations >= :least;",
        language="en", least=500)


_PAIR = subset.SqlTopic(
    "SELECT id, citations FROM nodes_snapshot WHERE language = :language AND citations >= :least",
    """SELECT e.* FROM edges_snapshot e LEFT SEMI JOIN nodes_query f ON f.id = e.from
       LEFT SEMI JOIN nodes_query t ON t.id = e.to""")


def _sql_pair(spark: SparkSession, folder: str) -> DataFrame:
    """Edges among the documents that a node text chose, each document citing those at a half and a third of its id."""
    docs = derive.table(spark, folder, "documents")
    cited = F.explode(F.array_distinct(F.array(F.floor(F.col("doc_id") / 2), F.floor(F.col("doc_id") / 3))))
    edges = docs.select("doc_id", cited.alias("cited")).select(
        F.concat(F.lit("W"), F.col("doc_id").cast("string")).alias("from"),
        F.concat(F.lit("W"), F.col("cited").cast("string")).alias("to"), F.lit(1).alias("weight"))
    place = f"{Scratch(spark).root}/pair"
    subset.build_sql(derive.document_nodes(spark, folder), edges, _PAIR, place, {"language": "en", "least": 300}, force=True)
    return spark.read.parquet(f"{place}/edges_query")


QUERIES = {
    "subset_sql_pair": _sql_pair,
    "ingest_nodes": _nodes,
    "ingest_edges": _edges,
    "json_props_parse": _props,
    **{name: _subset(topic) for name, topic in _TOPICS.items()},
    "subset_sql_parameters": _sql_subset,
}

_DOCS = """docs AS (
  SELECT 'W' || doc_id AS id, split_part(text, '.', 1) AS title, text AS abstract, lang AS language,
    n_chars AS citations, source, CAST(1990 + doc_id % 37 AS INTEGER) AS publication_year FROM documents)"""
_TITLE = "lower(title)"
_BOTH = "lower(title || ' ' || coalesce(abstract, ''))"


def _subset_sql(condition: str) -> str:
    return (f"WITH {_DOCS} SELECT id, title, language, citations, publication_year FROM docs "
            f"WHERE language = 'en' AND {condition}")


SQL = {
    "subset_sql_pair": f"""WITH {_DOCS}, n AS (SELECT id FROM docs WHERE language = 'en' AND citations >= 300),
      e AS (SELECT DISTINCT doc_id AS f, t FROM (
        SELECT doc_id, doc_id // 2 AS t FROM documents UNION ALL SELECT doc_id, doc_id // 3 FROM documents))
      SELECT 'W' || f AS "from", 'W' || t AS "to", 1 AS weight FROM e
      WHERE 'W' || f IN (SELECT id FROM n) AND 'W' || t IN (SELECT id FROM n)""",
    "ingest_nodes": r"""SELECT 'W' || doc_id AS id, '10.1000/' || doc_id AS doi,
        split_part(text, '.', 1) AS title,
        array_to_string(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), ' ') AS abstract, lang AS language,
        'article' AS type_openalex, 'journal-article' AS type_crossref, n_chars AS citations,
        source AS publication_source,
        array_to_string(list_distinct_kept, '|') AS countries,
        source || '|dept ' || lang AS institutions, 'ror/' || source || '|ror/' || lang AS institutions_ror,
        'archive|school' AS institutions_type, 'Author ' || doc_id AS authors,
        CAST(1990 + doc_id % 37 AS INTEGER) AS publication_year
      FROM (SELECT *, CASE WHEN upper(source[1:2]) = upper(lang) THEN [upper(lang)]
                           ELSE [upper(source[1:2]), upper(lang)] END AS list_distinct_kept FROM documents)""",
    "ingest_edges": """SELECT DISTINCT 'W' || doc_id AS "from", 'W' || t AS "to", 1 AS weight FROM (
        SELECT doc_id, doc_id // 2 AS t FROM documents UNION ALL SELECT doc_id, doc_id // 3 FROM documents)""",
    "json_props_parse": """SELECT event_type, count(*) AS events,
        CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total,
        max(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS k_max FROM events GROUP BY 1""",
    "subset_base": _subset_sql("true"),
    "subset_regex_title": _subset_sql(f"regexp_matches({_TITLE}, '{_WORDS['regex_title'][1]}')"),
    "subset_word_boundary": _subset_sql(f"regexp_matches({_TITLE}, '{_WORDS['word_boundary'][1]}')"),
    "subset_title_abstract": _subset_sql(f"regexp_matches({_BOTH}, '{_WORDS['title_abstract'][1]}')"),
    "subset_two_regex": _subset_sql(f"regexp_matches({_BOTH}, '{_WORDS['regex_title'][1]}') "
                                    f"AND regexp_matches({_BOTH}, '{_WORDS['title_abstract'][1]}')"),
    "subset_like": _subset_sql(f"{_TITLE} LIKE '%er%'"),
    "subset_sql_parameters": f"WITH {_DOCS} SELECT id, citations FROM docs WHERE language = 'en' AND citations >= 500",
}
