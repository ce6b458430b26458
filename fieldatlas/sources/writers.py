"""Writers for Parquet, TSV, CSV and JSON tables."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldatlas.functions.text import printable

WRITE_MODES = ("overwrite", "append", "error", "errorifexists", "ignore")


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> int:
    """Write snappy Parquet and return the row count measured during the write.

    A partitioned write is rebalanced on its columns first, so a folder gets a
    few files of a good size; adaptive execution splits the rows of a hot value.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode!r}; use one of {', '.join(WRITE_MODES)}")
    seen = Observation()
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode) \
               .option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get.get("rows", 0)


def save_external_table(df: DataFrame, name: str, path: str, mode: str = "errorifexists",
                        partition_by: Sequence[str] = ()) -> None:
    """Create a catalog table over an external folder from a query."""
    writer = df.write.format("parquet").mode(mode).option("path", path).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def write_tsv(df: DataFrame, path: str, header: bool, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, sep="\t", header=header)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with headers; control characters are removed from every text column."""
    texts = {name for name, kind in df.dtypes if kind == "string"}
    clean = df.select(*[printable(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`")
                        for c in df.columns])
    clean.write.mode(mode).csv(path, header=True, escape='"')


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_manifest(spark: SparkSession, manifest: dict, path: str) -> None:
    """Append one run's settings and counts as a JSON line."""
    line = json.dumps(manifest, sort_keys=True)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def ensure_writable(spark: SparkSession, paths: Sequence[str], force: bool = False,
                    tables: Sequence[str] = ()) -> None:
    """Refuse to go on when an output exists, unless forced."""
    if force:
        return
    taken = [p for p in paths if path_exists(spark, p)]
    taken += [t for t in tables if spark.catalog.tableExists(t)]
    if taken:
        raise FileExistsError(f"outputs exist (pass force=True to replace them): {', '.join(taken)}")


def reuse_or_compute(spark: SparkSession, ids: DataFrame, path: str, compute) -> DataFrame:
    """Stored (id, embedding) rows if they cover every id, else a fresh full computation.

    ``compute`` gets the id table and returns (id, embedding) rows.
    """
    try:
        stored = spark.read.parquet(path)
    except AnalysisException:
        stored = None
    if stored is not None and ids.join(stored, "id", "left_anti").isEmpty():
        return stored.join(ids.select("id"), "id", "left_semi")
    write_table(compute(ids), path)
    return spark.read.parquet(path)
