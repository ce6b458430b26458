"""Citation network: induced edges, dense ids and the three exchange files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldatlas.operators.ranking import dense_index
from fieldatlas.session import Scratch
from fieldatlas.sources.writers import write_tsv


def induced_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose two ends are both in the node set."""
    ids = nodes.select("id").where(F.col("id").isNotNull())
    return edges.join(ids.withColumnRenamed("id", "from"), "from", "left_semi") \
                .join(ids.withColumnRenamed("id", "to"), "to", "left_semi") \
                .select("from", "to", "weight")


def node_index(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Dense ids of all end points in binary string order: rows ``id, node_str``."""
    ends = edges.select(F.col("from").alias("node_str")).unionAll(edges.select(F.col("to").alias("node_str")))
    return dense_index(ends, "node_str", "id", scratch)


def network_edges(edges: DataFrame, index: DataFrame) -> DataFrame:
    """Edges between dense ids, sorted by both ends."""
    source = index.select(F.col("node_str").alias("from"), F.col("id").alias("_from"))
    target = index.select(F.col("node_str").alias("to"), F.col("id").alias("_to"))
    return edges.join(source, "from").join(target, "to") \
                .select(F.col("_from").alias("from"), F.col("_to").alias("to"), "weight") \
                .orderBy("from", "to")


def network_nodes(index: DataFrame) -> DataFrame:
    return index.select("id", F.lit(1).alias("value"))


def export_network(edges: DataFrame, path: str) -> None:
    """Write edges.txt, nodes_index.txt and nodes.txt as headerless TSV folders."""
    scratch = Scratch(edges.sparkSession)
    index = scratch.save(node_index(edges, scratch))
    write_tsv(network_edges(edges, index), f"{path}/edges.txt", header=False)
    write_tsv(index.select("id", "node_str"), f"{path}/nodes_index.txt", header=False)
    write_tsv(network_nodes(index), f"{path}/nodes.txt", header=False)
