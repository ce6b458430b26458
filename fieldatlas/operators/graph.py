"""Graph operators on edge tables.

An undirected graph is a table ``a, b, w`` with ``a <= b`` and one row per pair.
Loops are kept where they carry weight.  Every step is a join or a partial
aggregate by vertex; nothing ever lists the pairs or neighbours of a vertex in
one row, so hubs stay ordinary keys that adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas.operators.joins import lookup
from fieldatlas.operators.ranking import dense_index, with_group_rank
from fieldatlas.session import Scratch


def undirected(edges: DataFrame, src: str = "src", dst: str = "dst", weight: str = "weight",
               combine: str = "sum") -> DataFrame:
    """Fold directed and parallel edges into one weighted undirected edge per pair."""
    if combine not in ("sum", "max"):
        raise ValueError("combine must be 'sum' or 'max'")
    merge = F.sum if combine == "sum" else F.max
    return edges.groupBy(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b")) \
                .agg(merge(F.col(weight).cast("double")).alias("w"))


def both_directions(edges: DataFrame) -> DataFrame:
    """Rows ``u, v, w`` for both ends of every edge that is not a loop."""
    plain = edges.where("a <> b")
    return plain.select(F.col("a").alias("u"), F.col("b").alias("v"), "w").unionAll(
        plain.select(F.col("b").alias("u"), F.col("a").alias("v"), "w"))


def vertices(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("node")).unionAll(edges.select(F.col("b").alias("node"))).distinct()


def edge_diagnostics(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Edges, self-loops and exact duplicates of a directed edge list."""
    per_pair = edges.groupBy(src, dst).agg(F.count(F.lit(1)).alias("copies"))
    return per_pair.agg(
        F.sum("copies").alias("edges"),
        F.coalesce(F.sum(F.when(F.col(src) == F.col(dst), F.col("copies"))), F.lit(0)).alias("self_loops"),
        F.sum(F.col("copies") - 1).alias("duplicate_edges"))


# --- components ------------------------------------------------------------

def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """Smallest vertex id of the component of every vertex: rows ``node, component``.

    Alternates the large-star and small-star steps of Kiveris et al. (2014): the
    edge table shrinks towards one star per component in O(log^2 n) rounds,
    whatever the diameter.
    """
    pairs = scratch.save(edges.where("a <> b").select(F.col("b").alias("hi"), F.col("a").alias("lo")))
    with _spread(scratch.spark, pairs.count()):
        table = scratch.save(pairs.distinct())
        scratch.drop(pairs)
        mark = _fingerprint(table)
        for _ in range(max_rounds):
            previous = table
            table = scratch.save(_small_star(_large_star(table)))
            scratch.drop(previous)
            before, mark = mark, _fingerprint(table)
            if mark == before:
                break
        else:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        # the table has every vertex of a pair now: others once as ``hi``, the smallest of a component as ``lo``
        roots = scratch.save(table.select(F.col("lo").alias("node")).distinct())
        alone = scratch.save(vertices(edges.where("NOT coalesce(a <> b, false)")))
    labels = table.select(F.col("hi").alias("node"), F.col("lo").alias("component")) \
        .unionAll(roots.select("node", F.col("node").alias("component")))
    if alone.isEmpty():
        return labels
    return labels.unionAll(alone.join(labels.select("node"), "node", "left_anti")
                           .select("node", F.col("node").alias("component")))


_ROWS_A_TASK = 1 << 20


@contextmanager
def _spread(spark: SparkSession, rows: int) -> Iterator[None]:
    """More shuffle partitions while many rows are moved, so that no task's tables grow with the graph."""
    key = "spark.sql.shuffle.partitions"
    was = spark.conf.get(key)
    spark.conf.set(key, max(int(was), -(-rows // _ROWS_A_TASK)))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def _large_star(table: DataFrame) -> DataFrame:
    """Link the larger neighbours of each vertex to its smallest neighbour."""
    ends = table.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        table.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    lowest = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return table.select(F.col("lo").alias("u"), F.col("hi").alias("v")).transform(lookup, lowest, "u") \
                .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(table: DataFrame) -> DataFrame:
    """Link each vertex and its smaller neighbours to the smallest of them."""
    lowest = table.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = lookup(table, lowest, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionAll(lowest.select("hi", F.col("m").alias("lo"))).distinct()


def _fingerprint(table: DataFrame) -> tuple:
    return tuple(table.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def largest_component(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges of the largest component (ties: smallest label), ids kept."""
    labels = scratch.save(connected_components(edges, scratch))
    top = (labels.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.col("n").desc(), "component").limit(1))
    nodes = labels.join(top, "component", "left_semi").select("node")
    return nodes, induced(edges, nodes)


def induced(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among the nodes."""
    return edges.join(nodes.select(F.col("node").alias("a")), "a", "left_semi") \
                .join(nodes.select(F.col("node").alias("b")), "b", "left_semi").select("a", "b", "w")


# --- partitions ------------------------------------------------------------

def community_graph(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """One vertex per community, weights summed; inner weight becomes a loop."""
    left = labels.select(F.col("node").alias("a"), F.col("community").alias("ca"))
    right = labels.select(F.col("node").alias("b"), F.col("community").alias("cb"))
    return edges.join(left, "a").join(right, "b").groupBy(
        F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(F.sum("w").alias("w"))


def modularity(edges: DataFrame, labels: DataFrame, gamma: float = 1.0) -> DataFrame:
    """Newman modularity with resolution, as one row."""
    return coarse_modularity(community_graph(edges, labels), gamma)


def coarse_modularity(coarse: DataFrame, gamma: float = 1.0) -> DataFrame:
    """Modularity of the partition whose community graph is given."""
    ends = coarse.select(F.col("a").alias("c"), "w", F.when(F.col("a") == F.col("b"), F.col("w"))
                         .otherwise(0.0).alias("inner")).unionAll(
        coarse.select(F.col("b").alias("c"), "w", F.lit(0.0).alias("inner")))
    per = ends.groupBy("c").agg(F.sum("w").alias("volume"), F.sum("inner").alias("inner"))
    both = F.sum("volume")
    return per.agg((F.sum("inner") * 2.0 / both
                    - F.lit(gamma) * F.sum(F.col("volume") * F.col("volume")) / (both * both))
                   .alias("modularity"))


def compacted(labels: DataFrame, scratch: Scratch) -> DataFrame:
    """Renumber communities 0..K-1 in the order of their old ids."""
    index = dense_index(labels, "community", "_new", scratch)
    return labels.join(index, "community").select("node", F.col("_new").alias("community"))


# --- sparsification --------------------------------------------------------

def local_top_edges(edges: DataFrame, keep: float, scratch: Scratch) -> DataFrame:
    """Pairs among the strongest ``ceil(keep * degree)`` edges of either end."""
    if not 0.0 < keep <= 1.0:
        raise ValueError("keep must lie in (0, 1]")
    ranked = with_group_rank(both_directions(edges), ["u"], [F.col("w").desc(), F.col("v").asc()],
                             "_rank", scratch, size_col="_degree")
    kept = F.greatest(F.lit(1), F.ceil(F.col("_degree") * F.lit(keep) - F.lit(1e-9)))
    return ranked.where(F.col("_rank") <= kept) \
                 .select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def spanning_forest(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """Maximum spanning forest pairs ``a, b``, heaviest first, ties by (a, b).

    Boruvka: in each round every component takes its best outgoing edge, chosen
    by a partial aggregate; parallel links between two components fold to the
    best one, so the table shrinks fast.  Edges are numbered once in order of
    preference, so that rounds compare plain numbers.
    """
    order = [(-F.col("w")).asc(), F.col("a").asc(), F.col("b").asc()]
    ranked = scratch.save(edges.where("a <> b").orderBy(*order).select("a", "b", F.monotonically_increasing_id().alias("edge")))
    # x, y are the current components of an edge's ends
    links = ranked.select(F.col("a").alias("x"), F.col("b").alias("y"), "edge")
    chosen: list[DataFrame] = []
    for _ in range(max_rounds):
        ends = links.select(F.col("x").alias("c"), "edge").unionAll(links.select(F.col("y").alias("c"), "edge"))
        best = ends.groupBy("c").agg(F.min("edge").alias("edge")).select("edge").distinct()
        picked = scratch.save(links.join(best, "edge", "left_semi"))
        if picked.isEmpty():
            scratch.drop(picked)
            break
        chosen.append(picked.select("edge"))
        merged = scratch.save(connected_components(
            picked.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), scratch))
        left = merged.select(F.col("node").alias("x"), F.col("component").alias("cx"))
        right = merged.select(F.col("node").alias("y"), F.col("component").alias("cy"))
        previous = links
        links = scratch.save(
            links.join(left, "x").join(right, "y").where("cx <> cy")
            .groupBy(F.least("cx", "cy").alias("x"), F.greatest("cx", "cy").alias("y"))
            .agg(F.min("edge").alias("edge")))
        scratch.drop(previous)
        scratch.drop(merged)
    else:
        raise RuntimeError(f"spanning forest did not settle in {max_rounds} rounds")
    if not chosen:
        return edges.select("a", "b").limit(0)
    forest = chosen[0]
    for part in chosen[1:]:
        forest = forest.unionAll(part)
    return ranked.join(forest, "edge", "left_semi").select("a", "b").distinct()


def sparsify(edges: DataFrame, keep: float, scratch: Scratch) -> DataFrame:
    """Local top edges and a maximum spanning forest; loops go, parallel edges keep the heaviest."""
    simple = scratch.save(edges.where("a <> b").groupBy("a", "b").agg(F.max("w").alias("w")))
    kept = local_top_edges(simple, keep, scratch).unionAll(spanning_forest(simple, scratch)).distinct()
    return simple.join(kept, ["a", "b"], "left_semi")
