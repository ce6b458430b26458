"""Readers for the raw works, Parquet tables, network files and optional tables."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldatlas.sources import schemas


def read_works(spark: SparkSession, path: str) -> DataFrame:
    """Nested work rows from JSON lines; unreadable lines and works without id go.

    The JSON source parses each line once and only for the columns a query
    uses, which ``from_json`` on text rows does not.
    """
    return spark.read.schema(schemas.RAW_WORK).json(path).where(F.col("id").isNotNull())


def snapshot_date(spark: SparkSession, manifest: str, field: str = "date") -> str:
    """Date named by a JSON manifest."""
    row = spark.read.json(manifest, multiLine=True).first()
    if row is None or field not in row or not row[field]:
        raise ValueError(f"manifest {manifest} names no {field}")
    return str(row[field])


def dated_path(template: str, date: str) -> str:
    """Fill ``{SNAPSHOT_DATE}`` in an output path."""
    return template.replace("{SNAPSHOT_DATE}", date)


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Node table with its year partitions; columns older files lack read as null."""
    return spark.read.schema(schemas.NODES).parquet(path)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.EDGES).parquet(path)


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name in which columns missing on one side become null."""
    return old.unionByName(new, allowMissingColumns=True)


def read_network_edges(spark: SparkSession, path: str) -> DataFrame:
    """Headerless TSV edge list: src, dst, weight, ids from 0."""
    return spark.read.schema(schemas.NETWORK_EDGES).csv(path, sep="\t")


def read_network_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.NETWORK_INDEX).csv(path, sep="\t")


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """Headered TSV of node_id and the three cluster ids; other headers are refused."""
    wanted = schemas.CLUSTERS.names
    found = spark.read.csv(path, sep="\t", header=True).columns
    if found != wanted:
        raise ValueError(f"cluster file has columns {found}, expected {wanted}")
    return spark.read.schema(schemas.CLUSTERS).csv(path, sep="\t", header=True)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.EMBEDDINGS).parquet(path)


def read_optional(spark: SparkSession, path: str, schema: T.StructType | str,
                  required: bool = False) -> DataFrame:
    """A Parquet table, or an empty one with a warning when it does not exist."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if required:
            raise
        warnings.warn(f"optional table {path} is not available: {error.getCondition()}", stacklevel=2)
        return spark.createDataFrame([], schema)


def pick_column(df: DataFrame, candidates: Sequence[str], required: bool = True) -> str | None:
    """First candidate the table has."""
    for name in candidates:
        if name in df.columns:
            return name
    if required:
        raise KeyError(f"expected one of the columns {', '.join(candidates)}")
    return None


def with_column_named(df: DataFrame, candidates: Sequence[str], name: str) -> DataFrame:
    """Rename the first candidate the table has; add a null column when it has none."""
    found = pick_column(df, candidates, required=False)
    if found is None:
        return df.withColumn(name, F.lit(None).cast("string"))
    return df.withColumnRenamed(found, name)


def register_partitioned(spark: SparkSession, name: str, path: str, schema: T.StructType,
                         partition: str) -> None:
    """Declare an external partitioned table over a folder and find its partitions."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"PARTITIONED BY ({partition}) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
