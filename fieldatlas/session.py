"""Session settings and the scratch tables that cut long lineages.

Scratch tables live in the folder named by ``spark.checkpoint.dir``, so they
survive the loss of any executor.  Where the setting is absent they go to the
session's warehouse, which is shared as well.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution picks broadcast sides from measured shuffle sizes and
# splits the partitions of hot keys, so no join below carries a size hint.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",  # ranks cut before the shuffle up to this
}

def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for scratch tables: spark.checkpoint.dir, else a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


class Scratch:
    """Writes intermediate tables and reads them back with a short plan.

    Used as a context manager it removes its tables at the end of the block, so
    the block must have written its results elsewhere.  What is still there when
    the driver ends is removed with it.
    """

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.clear()

    def clear(self) -> None:
        """Remove every table of this object."""
        folder, files = self._files(self.root)
        files.delete(folder, True)

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{scratch_folder(spark).rstrip('/')}/fieldatlas-{uuid.uuid4().hex}"
        self._count = 0
        folder, files = self._files(self.root)
        files.mkdirs(folder)
        files.deleteOnExit(folder)

    def _files(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _next(self) -> str:
        self._count += 1
        return f"{self.root}/t{self._count}"

    def save(self, df: DataFrame) -> DataFrame:
        path = self._next()
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        return table

    def save_lines(self, df: DataFrame) -> str:
        """Write a one-column text table and return its folder."""
        path = self._next()
        df.write.text(path)
        return path

    def drop(self, table: DataFrame | None) -> None:
        """Remove a scratch table that nothing reads any more."""
        path = table.__dict__.pop("_scratch_path", None) if table is not None else None
        if path is not None:
            target, files = self._files(path)
            files.delete(target, True)
