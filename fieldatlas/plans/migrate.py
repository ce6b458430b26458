"""Promote meso clusters to effective micro clusters, keeping the lineage."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas.operators.reports import level_counts
from fieldatlas.sources.writers import write_manifest

# Fixed value: the policy name recorded with each promoted row.
POLICY = "meso_as_micro"
LINEAGE = ("micro_cluster_original", "micro_assignment_policy", "micro_assignment_version",
           "micro_assignment_run_id")
REQUIRED = ("node_id", "micro_cluster", "meso_cluster", "macro_cluster")


def promoted(clusters: DataFrame, version: str, run_id: str) -> DataFrame:
    """The same rows with meso ids as micro ids and the old ids kept beside them."""
    first = "micro_cluster_original" if "micro_cluster_original" in clusters.columns else "micro_cluster"
    kept = [F.col("meso_cluster").cast("bigint").alias(c) if c == "micro_cluster" else F.col(c)
            for c in clusters.columns if c not in LINEAGE]
    return clusters.select(
        *kept, F.col(first).cast("bigint").alias(LINEAGE[0]), F.lit(POLICY).alias(LINEAGE[1]),
        F.lit(version).alias(LINEAGE[2]), F.lit(run_id).alias(LINEAGE[3]))


def projected_counts(clusters: DataFrame) -> DataFrame:
    """Counts as they will be after the promotion."""
    return level_counts(clusters.select(F.col("meso_cluster").alias("micro_cluster"),
                                        "meso_cluster", "macro_cluster"))


def _counts(df: DataFrame) -> dict[str, int]:
    return level_counts(df).first().asDict()


def migrate(spark: SparkSession, root: str, version: str, run_id: str | None = None,
            dry_run: bool = False, force: bool = False) -> dict:
    """Promote the assignment table under ``root`` and return the run's manifest.

    ``root/versions`` is an append-only table whose last row names the live
    folder.  The new version is written and checked beside the old one and only
    then named; the old folder stays as the archive, so a failure at any point
    leaves the live table as it was, and ``point_to`` goes back to an archive.
    """
    run_id = run_id or uuid.uuid4().hex
    source = live_folder(spark, root)
    clusters = spark.read.parquet(f"{root}/{source}")
    missing = sorted(set(REQUIRED) - set(clusters.columns))
    if missing:
        raise ValueError(f"assignment table lacks {', '.join(missing)}")
    if not force and {"micro_assignment_policy", "micro_cluster_original"} & set(clusters.columns):
        raise RuntimeError("assignment table is already promoted; pass force=True to promote it again")
    before = _counts(clusters)
    if before["rows_total"] == 0:
        raise RuntimeError("assignment table is empty")
    projected = projected_counts(clusters).first().asDict()
    manifest = {"policy": POLICY, "version": version, "run_id": run_id, "source": source,
                "before": before, "projected": projected}
    if dry_run:
        return manifest
    target = f"run_id={run_id}"
    promoted(clusters, version, run_id).write.mode("errorifexists").parquet(f"{root}/{target}")
    after = _counts(spark.read.parquet(f"{root}/{target}"))
    if after != projected:
        raise RuntimeError(f"promoted table differs from the projection: {after} != {projected}")
    point_to(spark, root, target)
    manifest |= {"archive": source, "target": target, "after": after,
                 "timestamp_utc": datetime.now(timezone.utc).isoformat()}
    write_manifest(spark, manifest, f"{root}/manifests")
    return manifest


def live_folder(spark: SparkSession, root: str) -> str | None:
    """Folder of the live version, or null before the first one is named."""
    try:
        versions = spark.read.parquet(f"{root}/versions")
    except AnalysisException:
        return None
    return versions.agg(F.max_by("folder", "step").alias("folder")).first()["folder"]


def point_to(spark: SparkSession, root: str, folder: str) -> None:
    """Make ``folder`` the live version; also the way back to an archived one."""
    step = 0
    if live_folder(spark, root) is not None:
        step = spark.read.parquet(f"{root}/versions").agg(F.max("step")).first()[0] + 1
    spark.createDataFrame([(step, folder)], "step bigint, folder string").coalesce(1) \
         .write.mode("append").parquet(f"{root}/versions")
