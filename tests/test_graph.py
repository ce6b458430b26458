import random

import pytest
from pyspark.sql import functions as F

from fieldatlas.catalog import roundtrips
from fieldatlas.operators import communities, graph
from fieldatlas.plans import clustering, network
from fieldatlas.sources import readers


def edge_table(spark, edges):
    return spark.createDataFrame([(a, b, float(w)) for a, b, w in edges], "src bigint, dst bigint, weight double")


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def labels_by_hand(edges):
    parent = {}
    for a, b, *_ in edges:
        parent.setdefault(a, a)
        parent.setdefault(b, b)
        x, y = find(parent, a), find(parent, b)
        parent[max(x, y)] = min(x, y)
    return {n: find(parent, n) for n in parent}


def random_edges(seed, nodes, count):
    rng = random.Random(seed)
    return [(rng.randrange(nodes), rng.randrange(nodes), rng.randrange(1, 9)) for _ in range(count)]


CHAIN = [(i, i + 1, 1) for i in range(1000, 1120)]
HUB = [(500, i, 1) for i in range(300)]


@pytest.mark.parametrize("edges", [random_edges(1, 300, 200), CHAIN + HUB, [(3, 3, 1), (4, 5, 1)]],
                         ids=["random", "chain_and_hub", "loop"])
def test_components(spark, scratch, edges):
    found = graph.connected_components(graph.undirected(edge_table(spark, edges)), scratch)
    assert dict(found.select("node", "component").collect()) == labels_by_hand(edges)


def test_largest_component_keeps_ids_and_breaks_ties(spark, scratch):
    edges = [(10, 11, 1), (11, 12, 1), (1, 2, 1), (2, 3, 1), (7, 8, 1)]
    nodes, inside = graph.largest_component(graph.undirected(edge_table(spark, edges)), scratch)
    assert sorted(r[0] for r in nodes.collect()) == [1, 2, 3]
    assert sorted((r.a, r.b) for r in inside.collect()) == [(1, 2), (2, 3)]


def kruskal(edges):
    best = {}
    for a, b, w in edges:
        if a != b:
            pair = (min(a, b), max(a, b))
            best[pair] = max(w, best.get(pair, 0))
    parent = {n: n for pair in best for n in pair}
    kept = set()
    for (a, b), _ in sorted(best.items(), key=lambda item: (-item[1], item[0])):
        x, y = find(parent, a), find(parent, b)
        if x != y:
            parent[x] = y
            kept.add((a, b))
    return best, kept


def test_spanning_forest_equals_kruskal(spark, scratch):
    edges = random_edges(3, 120, 400)
    _, kept = kruskal(edges)
    table = graph.undirected(edge_table(spark, edges), combine="max")
    assert {(r.a, r.b) for r in graph.spanning_forest(table, scratch).collect()} == kept


def test_sparsify_keeps_local_top_and_forest(spark, scratch):
    edges = random_edges(4, 60, 500) + [(5, 5, 3)]
    best, forest = kruskal(edges)
    near = {}
    for (a, b), w in best.items():
        near.setdefault(a, []).append((-w, b))
        near.setdefault(b, []).append((-w, a))
    wanted = set(forest)
    for node, others in near.items():
        keep = max(1, -(-3 * len(others) // 10))
        wanted |= {(min(node, v), max(node, v)) for _, v in sorted(others)[:keep]}
    table = graph.undirected(edge_table(spark, edges), combine="max")
    assert {(r.a, r.b) for r in graph.sparsify(table, 0.30, scratch).collect()} == wanted
    with pytest.raises(ValueError):
        graph.local_top_edges(table, 0.0, scratch)


def test_modularity_of_two_triangles(spark):
    edges = [(0, 1, 1), (1, 2, 1), (0, 2, 1), (3, 4, 1), (4, 5, 1), (3, 5, 1), (2, 3, 1)]
    table = graph.undirected(edge_table(spark, edges))
    labels = spark.createDataFrame([(i, i // 3) for i in range(6)], "node bigint, community bigint")
    assert graph.modularity(table, labels).first()[0] == pytest.approx(6 / 7 - 0.5)


def cliques(count, size):
    edges = []
    for c in range(count):
        base = c * size
        edges += [(base + i, base + j, 1) for i in range(size) for j in range(i)]
        edges.append((base, ((c + 1) % count) * size, 1))
    return edges


def test_communities_recover_planted_cliques(spark, scratch):
    table = graph.undirected(edge_table(spark, cliques(6, 6)))
    found = communities.detect(table, graph.vertices(table), 1.0, scratch, refine=True, connected=True)
    groups = {}
    for node, label in found.collect():
        groups.setdefault(label, set()).add(node)
    assert sorted(map(sorted, groups.values())) == [list(range(c * 6, c * 6 + 6)) for c in range(6)]


def test_refinement_splits_what_a_bridge_holds_together(spark, scratch):
    edges = cliques(1, 6)[:-1] + [(10 + a, 10 + b, w) for a, b, w in cliques(1, 6)[:-1]] + [(50, 0, 0.2), (50, 10, 0.1)]
    edges += [(a + shift, b + shift, w) for shift in (20, 30, 40) for a, b, w in cliques(1, 6)[:-1]]
    table = scratch.save(graph.undirected(edge_table(spark, edges)))
    start = graph.vertices(table).select("node", F.when(F.col("node") % 50 < 20, 0).otherwise(
        F.floor(F.col("node") / 10)).cast("bigint").alias("community"))
    joint = dict(communities._split_disconnected(table, start, scratch).collect())
    assert joint[0] == joint[10] == joint[50]  # connected inside, so components leave it whole
    parts = {r.node: r.part for r in communities.refined_parts(table, start, 1.0, scratch).collect()}
    given = dict(start.collect())
    inner = [(a, b) for a, b, _ in edges if parts[a] == parts[b]]
    for node, part in parts.items():
        assert given[node] == given[part]
        assert labels_by_hand(inner).get(node, node) == labels_by_hand(inner).get(part, part)
    found = dict(communities.leiden(table, graph.vertices(table), 1.0, scratch, start=start).collect())
    assert found[0] == found[5] == found[50] != found[10] == found[15] and len(set(found.values())) == 5


def test_modularity_never_falls_between_levels(spark, scratch):
    table = scratch.save(graph.undirected(edge_table(spark, random_edges(6, 40, 90))))
    steps = []
    found = communities.detect(table, graph.vertices(table), 1.0, scratch, refine=True, qualities=steps)
    assert len(steps) >= 3 and all(b >= a for a, b in zip(steps, steps[1:], strict=False))
    assert graph.modularity(table, found, 1.0).first()[0] == pytest.approx(steps[-1])


def test_communities_do_not_depend_on_row_order(spark, scratch):
    rows = cliques(4, 5)
    random.Random(9).shuffle(rows)
    results = []
    for parts in (1, 5):
        table = graph.undirected(edge_table(spark, rows).repartition(parts))
        found = communities.detect(table, graph.vertices(table), 1.0, scratch)
        results.append(sorted(map(tuple, graph.compacted(found, scratch).collect())))
    assert results[0] == results[1]


def test_three_levels_cover_the_largest_component_once(spark):
    edges = edge_table(spark, cliques(5, 5) + [(900, 901, 1)])
    clusters = clustering.three_levels(edges, gammas=(1.0, 0.5, 0.3)).collect()
    assert sorted(r.node_id for r in clusters) == list(range(25))
    parents = {}
    for r in clusters:
        assert parents.setdefault(("m", r.micro_cluster), r.meso_cluster) == r.meso_cluster
        assert parents.setdefault(("s", r.meso_cluster), r.macro_cluster) == r.macro_cluster


def test_cluster_export(spark, tmp_path):
    clusters = spark.createDataFrame([(5, 0, 0, 0), (6, 1, 0, 0)], readers.schemas.CLUSTERS)
    manifest = clustering.export_clusters(clusters, str(tmp_path), query="q")
    assert manifest["rows_total"] == 2 and manifest["distinct_micro"] == 2
    assert readers.read_clusters(spark, f"{tmp_path}/clusters").count() == 2
    assert '"query": "q"' in spark.read.text(f"{tmp_path}/manifests").first()[0]


def test_domain_and_totality_checks(spark):
    with pytest.raises(RuntimeError, match="dense"):
        clustering.check_domain(spark.createDataFrame([(0,), (2,)], "c bigint"), "micro")
    with pytest.raises(RuntimeError, match="without a cluster"):
        clustering.check_total(spark.createDataFrame([(1, None)], "node_id bigint, micro_cluster bigint"))


def test_network_export_round_trip(spark, tmp_path):
    edges = spark.createDataFrame([("W2", "W10", 1), ("W10", "W1", 1), ("W2", "W2", 1)],
                                  "from string, to string, weight int")
    network.export_network(edges, str(tmp_path))
    index = {r.node_str: r.id for r in readers.read_network_index(spark, f"{tmp_path}/nodes_index.txt").collect()}
    assert index == {"W1": 0, "W10": 1, "W2": 2}
    got = [tuple(r) for r in readers.read_network_edges(spark, f"{tmp_path}/edges.txt").collect()]
    assert sorted(got) == [(1, 0, 1.0), (2, 1, 1.0), (2, 2, 1.0)]


def test_induced_edges_need_both_ends(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 1), ("a", "a", 1)], "from string, to string, weight int")
    nodes = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    assert sorted(map(tuple, network.induced_edges(edges, nodes).collect())) == [("a", "a", 1), ("a", "b", 1)]


def test_edge_diagnostics(spark):
    edges = spark.createDataFrame([(1, 2), (1, 2), (2, 1), (3, 3), (3, 3)], "src int, dst int")
    assert tuple(graph.edge_diagnostics(edges, "src", "dst").first()) == (5, 2, 2)


def test_isolated_vertices_stay_alone(spark, scratch):
    table = graph.undirected(edge_table(spark, [(1, 2, 1)]))
    nodes = spark.createDataFrame([(1,), (2,), (7,)], "node bigint")
    found = dict(communities.detect(table, nodes, 1.0, scratch).collect())
    assert found[7] == 7 and found[1] == found[2]


def test_empty_graph(spark, scratch):
    table = graph.undirected(edge_table(spark, [(1, 1, 2)])).where(F.col("a") != F.col("b"))
    assert graph.sparsify(table, 0.3, scratch).count() == 0


def test_refinement_rounds_do_not_grow_with_the_vertices(spark, scratch):
    """1,200 leaves that surely gain join their stars in a few rounds; half of them a round would take over ten."""
    rows = [(100 * hub, 100 * hub + leaf, 1) for hub in range(40) for leaf in range(1, 31)]
    table = scratch.save(graph.undirected(edge_table(spark, rows)))
    start = graph.vertices(table).withColumn("community", F.floor(F.col("node") / 100).cast("bigint"))
    parts = dict(communities.refined_parts(table, start, 10.0, scratch, rounds=8).collect())
    pairs = {(part, node // 100) for node, part in parts.items()}
    assert len(parts) == 1240 and len(pairs) == 40 and len({part for part, _ in pairs}) == 40


def test_refinement_rounds_run_on_parts(spark, scratch, monkeypatch):
    """Each round sees one vertex for each part; all rounds used to see all 1,240 vertices and 2,400 ends."""
    rows = [(100 * hub, 100 * hub + leaf, 1) for hub in range(40) for leaf in range(1, 31)]
    table = scratch.save(graph.undirected(edge_table(spark, rows)))
    start = graph.vertices(table).withColumn("community", F.floor(F.col("node") / 100).cast("bigint"))
    sizes, picks = [], communities._picks

    def counted(ends, state, *rest):
        sizes.append((ends.count(), state.count(), state.agg(F.sum("members")).first()[0]))
        return picks(ends, state, *rest)

    monkeypatch.setattr(communities, "_picks", counted)
    communities.refined_parts(table, start, 10.0, scratch).collect()
    assert sizes[0] == (2400, 1240, 1240) and sizes[-1][:2] == (0, 40)
    assert all(b[0] < a[0] for a, b in zip(sizes[1:], sizes[2:], strict=False)) and {s[2] for s in sizes} == {1240}


def test_planted_stars_stay_apart_however_many_there_are(spark, scratch):
    """Of 400 customers none has an opening with so many links that its leaves would leave it."""
    orders = spark.range(3, 1203).select(F.col("id").alias("o_orderkey"), F.floor(F.col("id") / 3).alias("o_custkey"))
    edges, nodes, gamma = roundtrips._planted_links(orders, scratch)
    assert nodes.count() == 1200
    rows = edges.collect()
    twice, degree, links = 2 * sum(r.w for r in rows), {}, []
    for a, b, w in rows:
        if a // 3 != b // 3:
            links.append((a // 3, b // 3, w))
        for end in (a, b):
            degree[end // 3] = degree.get(end // 3, 0) + w
    assert len(links) == 399 and len(rows) == 1199
    assert all(1 > gamma * d / twice for d in degree.values())
    assert all(w < gamma * degree[a] * degree[b] / twice for a, b, w in links)


def test_leaves_follow_their_only_neighbour_where_it_pays(spark):
    edges = [(0, 1, 1), (0, 2, 1), (0, 3, 1), (3, 4, 1), (4, 5, 1), (5, 3, 1), (8, 9, 1), (7, 7, 1), (4, 6, 0.5), (6, 6, 1)]
    table = graph.undirected(edge_table(spark, edges))
    found = dict(communities._followed_leaves(table, 1.0).collect())
    assert found == {**{n: n for n in range(10)}, 1: 0, 2: 0, 9: 8}
    # at this resolution 2m / gamma is 4: a leaf of the star of 0, whose other degree is 4, is not sure to stay
    assert dict(communities._followed_leaves(table, 19 / 4).collect()) == {**{n: n for n in range(10)}, 9: 8}


def test_stars_are_settled_before_the_first_rounds(spark, scratch, monkeypatch):
    edges = [(c * 10, c * 10 + i, 1) for c in range(6) for i in range(1, 8)] + [(c * 10, c * 10 + 10, 0.1) for c in range(5)]
    sizes, moves = [], communities._local_moves
    monkeypatch.setattr(communities, "_local_moves", lambda level, *rest, **more: (
        sizes.append(level.count()), moves(level, *rest, **more))[1])
    table = graph.undirected(edge_table(spark, edges))
    found = dict(communities.detect(table, graph.vertices(table), 1.0, scratch, refine=True).collect())
    assert all(len({found[c * 10 + i] for i in range(8)}) == 1 for c in range(6)) and len(set(found.values())) > 1
    assert sizes[0] == 11 and max(sizes[1:]) == 47  # six loops and five links, then the whole graph once, to check


def test_forest_rounds_compare_plain_numbers(spark, scratch, monkeypatch):
    """A minimum of structs would sort all links twice a round; ties of weight go to the smaller pair."""
    plans, save = [], scratch.save
    monkeypatch.setattr(scratch, "save", lambda df: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), save(df))[1])
    table = graph.undirected(edge_table(spark, [(1, 2, 1), (2, 3, 1), (1, 3, 1), (3, 4, 2), (7, 8, 1), (9, 9, 5)]))
    assert {(r.a, r.b) for r in graph.spanning_forest(table, scratch).collect()} == {(1, 2), (1, 3), (3, 4), (7, 8)}
    assert len(plans) > 4 and not any("SortAggregate" in plan for plan in plans)


def test_components_of_loops_and_missing_ends(spark, scratch):
    rows = [(1, 2), (2, 3), (3, 3), (7, 7), (7, 7), (8, None), (9, 10)]
    edges = spark.createDataFrame(rows, "a long, b long")
    got = graph.connected_components(edges, scratch)
    assert sorted((r.node or -1, r.component or -1) for r in got.collect()) == [
        (-1, -1), (1, 1), (2, 1), (3, 1), (7, 7), (8, 8), (9, 9), (10, 9)]


def test_components_are_spread_by_the_size_of_the_graph(spark, scratch, monkeypatch):
    monkeypatch.setattr(graph, "_ROWS_A_TASK", 10)
    seen, was = [], spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(graph, "_large_star", lambda table, step=graph._large_star: seen.append(
        int(spark.conf.get("spark.sql.shuffle.partitions"))) or step(table))
    edges = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    assert {r.component for r in graph.connected_components(edges, scratch).collect()} == {0}
    assert set(seen) == {20} and spark.conf.get("spark.sql.shuffle.partitions") == was
