"""Network export, components, forests and communities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas import derive
from fieldatlas.catalog import fragments as q
from fieldatlas.functions.numbers import round_to
from fieldatlas.operators import communities, graph, reports
from fieldatlas.operators.joins import lookup
from fieldatlas.plans import clustering, network
from fieldatlas.session import Scratch


def _induced_edges(spark: SparkSession, folder: str) -> DataFrame:
    works = derive.works(spark, folder).where("citations >= 40 and title like '%red%'")
    return network.induced_edges(derive.citations(spark, folder), works)


def _index(spark: SparkSession, folder: str) -> DataFrame:
    return network.node_index(derive.citations(spark, folder), Scratch(spark))


def _network_edges(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    edges = derive.citations(spark, folder)
    return network.network_edges(edges, scratch.save(network.node_index(edges, scratch)))


def _components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
    return graph.connected_components(pairs, Scratch(spark))  # weights do not matter, so nothing is folded first


def _largest_component(spark: SparkSession, folder: str) -> DataFrame:
    nodes, _ = graph.largest_component(graph.undirected(derive.opening_citations(spark, folder)),
                                       Scratch(spark))
    return nodes


def _meso_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Nation of the customer of each work."""
    return derive.table(spark, folder, "orders").join(
        derive.table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("node"), F.col("c_nationkey").cast("bigint").alias("community"))


def _citation_graph(spark: SparkSession, folder: str) -> DataFrame:
    return graph.undirected(derive.numeric_citations(spark, folder))


def _modularity(spark: SparkSession, folder: str) -> DataFrame:
    found = graph.modularity(_citation_graph(spark, folder), _meso_labels(spark, folder), 1.0)
    return found.select((round_to(F.col("modularity") + 10, 9)).alias("modularity_plus_ten"))


def _forest_size(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    forest = graph.spanning_forest(scratch.save(_citation_graph(spark, folder)), scratch)
    return forest.agg(F.count(F.lit(1)).alias("forest_edges"))


def _sparse(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    coarse = graph.community_graph(_citation_graph(spark, folder), _meso_labels(spark, folder))
    return graph.sparsify(scratch.save(coarse), 0.30, scratch)


def _micro_communities(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    edges = scratch.save(graph.undirected(derive.lineage_citations(spark, folder)))
    found = communities.detect(edges, graph.vertices(edges), 10.0, scratch, refine=True)
    return graph.compacted(found, scratch)


def _hierarchy_checks(spark: SparkSession, folder: str) -> DataFrame:
    found = reports.hierarchy_summary(clustering.three_levels(derive.lineage_citations(spark, folder)))
    return found.drop("micro_clusters", "meso_clusters", "macro_clusters")


def _bridged(spark: SparkSession, folder: str) -> DataFrame:
    """Communities of pairs of customers that start as one and are held together by a weak bridge vertex.

    Every order of a customer with eight or more cites the first of them; the
    bridge (-1 - pair) hangs on both first orders, more on the even customer's.
    The resolution lies where leaving a star never pays and two stars are better
    apart, so the bridge belongs to the even star.  ``joint`` is what splitting
    the start by connected components leaves, named by the smallest order.
    """
    scratch = Scratch(spark)
    orders = derive.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    stars = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("hub"), F.count(F.lit(1)).alias("n")) \
                  .where("n >= 8").withColumn("pair", F.floor(F.col("o_custkey") / 2).cast("bigint"))
    whole = stars.groupBy("pair").agg(F.count(F.lit(1)).alias("m")).where("m = 2").select("pair")
    stars = scratch.save(stars.join(whole, "pair"))
    leaves = lookup(orders, stars.select("o_custkey", "hub", "pair"), "o_custkey")
    bridge = F.when(F.col("o_custkey") % 2 == 0, 0.2).otherwise(0.1)
    edges = leaves.where("o_orderkey <> hub").select(
        F.col("o_orderkey").alias("src"), F.col("hub").alias("dst"), F.lit(1.0).alias("weight")).unionAll(
        stars.select((-1 - F.col("pair")).alias("src"), F.col("hub").alias("dst"), bridge.alias("weight")))
    start = scratch.save(leaves.select(F.col("o_orderkey").alias("node"), F.col("pair").alias("community")).unionAll(
        stars.select((-1 - F.col("pair")).alias("node"), F.col("pair").alias("community")).distinct()))
    table = scratch.save(graph.undirected(edges))
    weight = table.agg(F.sum("w")).first()[0] or 0.0
    found = communities.leiden(table, start.select("node"), weight / 300.0, scratch, start=start)
    joint = graph.connected_components(table, scratch)

    def named(labels: DataFrame, key: str, name: str) -> DataFrame:
        first = labels.where("node >= 0").groupBy(key).agg(F.min("node").alias(name))
        return labels.join(first, key).select("node", name)

    return named(found, "community", "first").join(named(joint, "component", "joint"), "node")


QUERIES = {
    "communities_bridged": _bridged,
    "induced_edges": _induced_edges,
    "dense_index": _index,
    "network_edges": _network_edges,
    "network_nodes": lambda s, d: network.network_nodes(_index(s, d)),
    "edge_diagnostics": lambda s, d: graph.edge_diagnostics(derive.citations(s, d), "from", "to"),
    "undirected_graph": _citation_graph,
    "components": lambda s, d: _components(s, derive.opening_citations(s, d)),
    "components_citations": lambda s, d: _components(s, derive.numeric_citations(s, d)),
    "largest_component": _largest_component,
    "community_graph": lambda s, d: graph.community_graph(_citation_graph(s, d), _meso_labels(s, d)),
    "modularity_given": _modularity,
    "local_top_edges": lambda s, d: graph.local_top_edges(_citation_graph(s, d), 0.30, Scratch(s)),
    "spanning_forest_size": _forest_size,
    "sparsified_graph": _sparse,
    "communities_micro": _micro_communities,
    "hierarchy_qc": _hierarchy_checks,
}

_INDEX = """idx AS (
  SELECT node_str, row_number() OVER (ORDER BY node_str) - 1 AS id FROM (
    SELECT 'W' || l_orderkey AS node_str FROM lineitem UNION SELECT 'W' || l_partkey FROM lineitem))"""
_GRAPH = """g AS (
  SELECT least(l_orderkey, l_partkey) AS a, greatest(l_orderkey, l_partkey) AS b, CAST(count(*) AS DOUBLE) AS w
  FROM lineitem GROUP BY 1, 2)"""
_LABELS = """lab AS (
  SELECT o_orderkey AS node, CAST(c_nationkey AS BIGINT) AS community
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
_COARSE = f"""{_GRAPH}, {_LABELS}, cg AS (
  SELECT least(x.community, y.community) AS a, greatest(x.community, y.community) AS b, sum(w) AS w
  FROM g JOIN lab x ON g.a = x.node JOIN lab y ON g.b = y.node GROUP BY 1, 2)"""
# breadth-first labels of one component per round; each vertex enters once
_COMPONENTS = f"""{_GRAPH}, e AS (
  SELECT a AS u, b AS v FROM g UNION ALL SELECT b, a FROM g),
reach(node, component) USING KEY (node) AS (
  SELECT u, min(least(u, v)) FROM e GROUP BY u
  UNION
  SELECT e.v, min(r.component) FROM reach r JOIN e ON e.u = r.node
    JOIN recurring.reach c ON c.node = e.v
  WHERE r.component < c.component GROUP BY e.v)"""

_FAULTS = ("null_meso_docs", "null_macro_docs", "micro_without_meso", "micro_without_macro",
           "micro_with_multiple_meso", "micro_with_multiple_macro", "meso_without_macro",
           "meso_with_multiple_macro")

SQL = {
    "communities_bridged": """WITH s AS (SELECT o_custkey, min(o_orderkey) AS hub, o_custkey // 2 AS pair FROM orders
        GROUP BY o_custkey HAVING count(*) >= 8 QUALIFY count(*) OVER (PARTITION BY o_custkey // 2) = 2),
      n AS (SELECT o_orderkey AS node, hub AS first, pair FROM orders JOIN s USING (o_custkey)
        UNION ALL SELECT -1 - pair, hub, pair FROM s WHERE o_custkey % 2 = 0)
      SELECT node, first, min(first) OVER (PARTITION BY pair) AS joint FROM n""",
    "dense_index": f"WITH {_INDEX} SELECT id, node_str FROM idx",
    "network_edges": f"""WITH {_INDEX} SELECT f.id AS "from", t.id AS "to", 1 AS weight
      FROM lineitem JOIN idx f ON f.node_str = 'W' || l_orderkey JOIN idx t ON t.node_str = 'W' || l_partkey""",
    "network_nodes": f"WITH {_INDEX} SELECT id, 1 AS value FROM idx",
    "edge_diagnostics": """SELECT count(*) AS edges,
      count(*) FILTER (WHERE l_orderkey = l_partkey) AS self_loops,
      count(*) - count(DISTINCT (l_orderkey, l_partkey)) AS duplicate_edges FROM lineitem""",
    "undirected_graph": f"WITH {_GRAPH} SELECT * FROM g",
    "components": """WITH f AS (SELECT o_custkey, min(o_orderkey) AS component, count(*) AS n
        FROM orders GROUP BY 1)
      SELECT o_orderkey AS node, component FROM orders JOIN f USING (o_custkey) WHERE n > 1""",
    "components_citations": f"WITH RECURSIVE {_COMPONENTS} SELECT node, component FROM reach",
    "largest_component": """WITH f AS (SELECT o_custkey, min(o_orderkey) AS component, count(*) AS n
        FROM orders GROUP BY 1),
      t AS (SELECT o_custkey FROM f ORDER BY n DESC, component LIMIT 1)
      SELECT o_orderkey AS node FROM orders JOIN t USING (o_custkey)""",
    "community_graph": f"WITH {_COARSE} SELECT a, b, w FROM cg",
    "modularity_given": f"""WITH {_COARSE},
      ends AS (SELECT a AS c, w, CASE WHEN a = b THEN w ELSE 0 END AS i FROM cg UNION ALL SELECT b, w, 0 FROM cg),
      per AS (SELECT c, sum(w) AS vol, sum(i) AS i FROM ends GROUP BY c)
      SELECT floor((sum(i) * 2.0 / sum(vol) - sum(vol * vol) / (sum(vol) * sum(vol)) + 10) * 1000000000.0 + 0.5)
        / 1000000000.0 AS modularity_plus_ten FROM per""",
    "local_top_edges": f"""WITH {_GRAPH},
      ends AS (SELECT a AS u, b AS v, w FROM g WHERE a <> b UNION ALL SELECT b, a, w FROM g WHERE a <> b),
      r AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY w DESC, v) AS rn,
                   count(*) OVER (PARTITION BY u) AS deg FROM ends)
      SELECT DISTINCT least(u, v) AS a, greatest(u, v) AS b FROM r WHERE rn <= (deg * 3 + 9) // 10""",
    "spanning_forest_size": f"""WITH RECURSIVE {_COMPONENTS}
      SELECT count(*) - count(DISTINCT component) AS forest_edges FROM reach""",
    "sparsified_graph": f"""WITH RECURSIVE {q.FOREST},
      ends AS (SELECT a AS u, b AS v, w FROM g WHERE a <> b UNION ALL SELECT b, a, w FROM g WHERE a <> b),
      r AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY w DESC, v) AS rn,
                   count(*) OVER (PARTITION BY u) AS deg FROM ends),
      k AS (SELECT least(u, v) AS a, greatest(u, v) AS b FROM r WHERE rn <= (deg * 3 + 9) // 10
            UNION SELECT a, b FROM steps WHERE a IS NOT NULL)
      SELECT a, b, CAST(w AS DOUBLE) AS w FROM g JOIN k USING (a, b)""",
    "hierarchy_qc": "SELECT count(*) AS docs_total, " + ", ".join(
        f"CAST(0 AS BIGINT) AS {name}" for name in _FAULTS) + " FROM orders",
}
SQL["induced_edges"] = f"""WITH {q.WORKS},
  n AS (SELECT id FROM works WHERE citations >= 40 AND title LIKE '%red%')
  SELECT 'W' || l_orderkey AS "from", 'W' || l_partkey AS "to", 1 AS weight FROM lineitem
  WHERE 'W' || l_orderkey IN (SELECT id FROM n) AND 'W' || l_partkey IN (SELECT id FROM n)"""
