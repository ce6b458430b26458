"""Small Spark helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from fieldatlas.session import configure

# Python tasks see a few hundred texts at a time, whatever their length.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.parquet.compression.codec": "zstd",  # scratch tables
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",  # a table that is written needs its shuffles no more
}


def prepared(spark: SparkSession) -> SparkSession:
    configure(spark)
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def arrow_map(df: DataFrame, schema: str,
              step: Callable[[pa.RecordBatch], Iterator[dict[str, pa.Array]]]) -> DataFrame:
    """Apply ``step`` to every Arrow batch; it yields columns by name."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in step(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array)
                     else columns[f.name].cast(f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)
