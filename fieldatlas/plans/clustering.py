"""Three-level clustering of a citation network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldatlas.operators import communities, graph
from fieldatlas.operators.reports import level_counts
from fieldatlas.session import Scratch
from fieldatlas.sources.writers import write_manifest, write_tsv


def compose(micro: DataFrame, meso: DataFrame, macro: DataFrame) -> DataFrame:
    """Node -> micro -> meso -> macro in one table; every step must be total."""
    def renamed(labels: DataFrame, key: str, value: str) -> DataFrame:
        return labels.select(F.col("node").alias(key), F.col("community").alias(value))

    out = renamed(micro, "node_id", "micro_cluster") \
        .join(renamed(meso, "micro_cluster", "meso_cluster"), "micro_cluster", "left") \
        .join(renamed(macro, "meso_cluster", "macro_cluster"), "meso_cluster", "left") \
        .select("node_id", "micro_cluster", "meso_cluster", "macro_cluster")
    return out


def check_domain(ids: DataFrame, name: str) -> None:
    """Raise unless the single id column is exactly 0..K-1."""
    low, high, count = ids.distinct().agg(F.min(ids.columns[0]), F.max(ids.columns[0]),
                                          F.count(ids.columns[0])).first()
    if count and (low != 0 or high != count - 1):
        raise RuntimeError(f"{name} ids are not dense: {count} ids from {low} to {high}")


def check_total(clusters: DataFrame) -> None:
    """Raise when a node has no cluster at some level."""
    columns = [c for c in clusters.columns if c != "node_id"]
    missing = clusters.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()
    if any(missing.values()):
        raise RuntimeError(f"nodes without a cluster: {missing}")


def three_levels(edges: DataFrame, gammas: tuple[float, float, float] = (10.0, 5.0, 2.0),
                 keep: float = 0.30, from_pruned: bool = True, seed: int = 1,
                 rounds: int = 400) -> DataFrame:
    """Micro, meso and macro clusters of the largest component of a directed edge list.

    Input rows are ``src, dst, weight``; output rows are ``node_id`` and the three
    cluster ids, each level numbered from 0.
    """
    scratch = Scratch(edges.sparkSession)
    whole = scratch.save(graph.undirected(edges))
    nodes, inside = graph.largest_component(whole, scratch)
    nodes, inside = scratch.save(nodes), scratch.save(inside)

    micro = scratch.save(graph.compacted(
        communities.detect(inside, nodes, gammas[0], scratch, rounds=rounds, seed=seed, refine=True), scratch))
    meso, meso_raw, meso_graph = _upper_level(inside, micro, gammas[1], keep, seed, rounds, scratch)
    below = meso_graph if from_pruned else meso_raw
    macro, _, _ = _upper_level(below, meso, gammas[2], keep, seed, rounds, scratch)

    clusters = scratch.save(compose(micro, meso, macro))
    check_total(clusters)
    for level in ("micro", "meso", "macro"):
        check_domain(clusters.select(f"{level}_cluster"), level)
    return clusters


def _upper_level(edges: DataFrame, labels: DataFrame, gamma: float, keep: float, seed: int,
                 rounds: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Communities of the community graph: labels over it, and it before and after pruning."""
    raw = scratch.save(graph.community_graph(edges, labels))
    pruned = scratch.save(graph.sparsify(raw, keep, scratch))
    # communities without links are vertices too
    nodes = scratch.save(labels.select(F.col("community").alias("node")).distinct())
    found = communities.leiden(pruned, nodes, gamma, scratch, rounds=rounds, seed=seed)
    return scratch.save(graph.compacted(found, scratch)), raw, pruned


def export_clusters(clusters: DataFrame, path: str, **facts: str) -> dict:
    """Write the assignment as TSV with a header and append its counts to the manifests."""
    write_tsv(clusters.select("node_id", "micro_cluster", "meso_cluster", "macro_cluster"),
              f"{path}/clusters", header=True)
    manifest = {**facts, **level_counts(clusters).first().asDict()}
    write_manifest(clusters.sparkSession, manifest, f"{path}/manifests")
    return manifest
