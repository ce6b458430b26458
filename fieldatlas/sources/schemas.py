"""Fixed table layouts."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT = T.StringType()


def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(name, _TEXT) for name in names]


_INSTITUTION = T.StructType(_texts("display_name", "country_code", "ror", "type"))
_AUTHORSHIP = T.StructType([
    T.StructField("author", T.StructType(_texts("display_name"))),
    T.StructField("institutions", T.ArrayType(_INSTITUTION)),
])
_LOCATION = T.StructType([T.StructField("source", T.StructType(_texts("display_name")))])

RAW_WORK = T.StructType([
    *_texts("id", "doi", "title", "language", "type", "type_crossref"),
    T.StructField("abstract_inverted_index", T.MapType(_TEXT, T.ArrayType(T.IntegerType()))),
    T.StructField("publication_year", T.IntegerType()),
    T.StructField("cited_by_count", T.LongType()),
    T.StructField("referenced_works", T.ArrayType(_TEXT)),
    T.StructField("primary_location", _LOCATION),
    T.StructField("authorships", T.ArrayType(_AUTHORSHIP)),
])

NODES = T.StructType([
    *_texts("id", "doi", "title", "abstract", "language", "type_openalex", "type_crossref"),
    T.StructField("citations", T.LongType()),
    *_texts("publication_source"),
    *[T.StructField(name, T.ArrayType(_TEXT)) for name in
      ("countries", "institutions", "institutions_ror", "institutions_type", "authors")],
    T.StructField("publication_year", T.IntegerType()),
])

EDGES = T.StructType([*_texts("from", "to"), T.StructField("weight", T.IntegerType())])

NETWORK_EDGES = T.StructType([
    T.StructField("src", T.LongType()), T.StructField("dst", T.LongType()),
    T.StructField("weight", T.DoubleType())])
NETWORK_INDEX = T.StructType([T.StructField("id", T.LongType()), T.StructField("node_str", _TEXT)])

CLUSTERS = T.StructType([T.StructField(name, T.LongType()) for name in
                         ("node_id", "micro_cluster", "meso_cluster", "macro_cluster")])

EMBEDDINGS = T.StructType([T.StructField("cluster", T.LongType()),
                           T.StructField("embedding", T.ArrayType(T.FloatType()))])
