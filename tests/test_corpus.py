import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fieldatlas import derive
from fieldatlas.plans import ingest, subset
from fieldatlas.sources import readers, schemas, writers

PREFIX = "https://works.example/"
LINES = [
    json.dumps({
        "id": PREFIX + "W1", "title": "One", "publication_year": 2001, "cited_by_count": 3, "type": "article",
        "language": "en", "abstract_inverted_index": {"b": [1, 3], "a": [0], "c": [2]},
        "referenced_works": [PREFIX + "W2", PREFIX + "W2", PREFIX + "W1", "x", None],
        "primary_location": {"source": {"display_name": "Press"}},
        "authorships": [
            {"author": {"display_name": "Ann"}, "institutions": [
                {"display_name": "U", "country_code": "JP"}, {"display_name": None, "country_code": "JP"}]},
            {"author": {"display_name": None}, "institutions": [{"display_name": "V", "country_code": "FR"}]}]}),
    json.dumps({"id": PREFIX + "W2", "abstract_inverted_index": {}, "publication_year": "no year",
                "authorships": [{"author": {"display_name": "Bo"}, "institutions": None},
                                {"author": {"display_name": "Cy"}, "institutions": [{"display_name": "U"}]}]}),
    json.dumps({"id": PREFIX + "W3", "publication_year": 2002, "authorships": [], "referenced_works": []}),
    json.dumps({"id": "x", "referenced_works": [PREFIX + "W1"]}),
    json.dumps({"title": "no id"}), "not json", '{"id": "cut', "",
]


@pytest.fixture(scope="module")
def works(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "works.jsonl"
    path.write_text("\n".join(LINES))
    return readers.read_works(spark, str(path))


def test_nodes(works):
    got = {r.id: r for r in ingest.nodes(works, PREFIX).collect()}
    assert set(got) == {"W1", "W2", "W3", ""}
    one, two, three = got["W1"], got["W2"], got["W3"]
    assert one.abstract == "a b c b" and two.abstract == "" and three.abstract is None
    assert one.countries == ["JP", "FR"] and one.institutions == ["U", None, "V"]
    assert one.authors == ["Ann"] and one.publication_source == "Press"
    # one missing institution list makes the whole list null
    assert two.institutions is None and two.authors == ["Bo", "Cy"] and two.publication_year is None
    assert three.authors is None


def test_edges(works):
    got = sorted(tuple(r) for r in ingest.edges(works, PREFIX).collect())
    assert got == [("", "W1", 1), ("W1", "W1", 1), ("W1", "W2", 1)]


def test_edge_scan_reads_only_ids(works):
    plan = ingest.edges(works, PREFIX)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string,referenced_works:array<string>>" in plan


def test_ingest_writes_partitions_and_counts(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "part.jsonl").write_text("\n".join(LINES))
    (tmp_path / "manifest").write_text('{"date": "2026-06-26"}')
    counts = ingest.ingest(spark, str(tmp_path / "raw"), str(tmp_path / "out/{SNAPSHOT_DATE}"), PREFIX,
                           manifest=str(tmp_path / "manifest"))
    assert counts == {"nodes": 4, "edges": 3}
    nodes = readers.read_nodes(spark, str(tmp_path / "out/2026-06-26/nodes_snapshot"))
    assert nodes.where("publication_year = 2001").count() == 1
    plan = nodes.where("publication_year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(publication_year" in plan


def test_write_modes(spark, tmp_path):
    df = spark.range(3)
    assert writers.write_table(df, str(tmp_path / "t")) == 3
    with pytest.raises(ValueError):
        writers.write_table(df, str(tmp_path / "t"), mode="replace")
    with pytest.raises(FileExistsError):
        writers.ensure_writable(spark, [str(tmp_path / "t")])
    writers.ensure_writable(spark, [str(tmp_path / "t")], force=True)
    writers.write_table(df, str(tmp_path / "t"), mode="append")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6


def test_external_table(spark, tmp_path):
    df = spark.createDataFrame([(1, 2001), (2, 2002)], "id bigint, publication_year int")
    writers.save_external_table(df, "ext_nodes", str(tmp_path / "e"), partition_by=["publication_year"])
    assert spark.table("ext_nodes").where("publication_year = 2002").first()["id"] == 2
    with pytest.raises(FileExistsError):
        writers.ensure_writable(spark, [], tables=["ext_nodes"])
    spark.sql("DROP TABLE ext_nodes")


def test_register_partitioned(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("a", 2001)], "id string, publication_year int").write.partitionBy("publication_year") \
         .parquet(path)
    schema = spark.createDataFrame([], "id string, publication_year int").schema
    readers.register_partitioned(spark, "found_nodes", path, schema, "publication_year")
    assert spark.table("found_nodes").count() == 1
    spark.sql("DROP TABLE found_nodes")


def test_csv_drops_control_characters(spark, tmp_path):
    df = spark.createDataFrame([("a\x01b\x0bc, \"q\"", 1)], "t string, n int")
    writers.write_csv(df, str(tmp_path / "c"))
    back = spark.read.csv(str(tmp_path / "c"), header=True, escape='"').first()
    assert back["t"] == 'abc, "q"'


def test_readers_check_and_default(spark, tmp_path):
    clusters = spark.createDataFrame([(1, 2, 3, 4)], schemas.CLUSTERS)
    writers.write_tsv(clusters, str(tmp_path / "c"), header=True)
    assert readers.read_clusters(spark, str(tmp_path / "c")).first() == (1, 2, 3, 4)
    writers.write_tsv(clusters.withColumnRenamed("node_id", "node"), str(tmp_path / "d"), header=True)
    with pytest.raises(ValueError, match="expected"):
        readers.read_clusters(spark, str(tmp_path / "d"))
    with pytest.warns(UserWarning, match="not available"):
        assert readers.read_optional(spark, str(tmp_path / "none"), "a int").count() == 0
    df = spark.range(1).toDF("article_id")
    assert readers.pick_column(df, ["id", "article_id"]) == "article_id"
    assert readers.pick_column(df, ["x"], required=False) is None
    with pytest.raises(KeyError):
        readers.pick_column(df, ["x"])
    assert readers.with_column_named(df, ["abstract"], "abstract").columns == ["article_id", "abstract"]
    assert readers.evolve(df, df.withColumn("more", F.lit(1))).columns == ["article_id", "more"]


def nodes(spark):
    rows = [("1", "Quantum computing in Cities", None, 2000), ("2", "Scarcity of urbane folk", "city life", 1990),
            ("3", None, "quantum computers", 2000), ("4", "One Health", None, 2026), ("5", "Machine Learning", "of biodiversity", 2001),
            ("6", "deep learning", "no", 1989), ("7", "x", "On quantum computation", 2000)]
    return spark.createDataFrame(rows, "id string, title string, abstract string, publication_year int") \
        .withColumn("type_openalex", F.lit("article")).withColumn("language", F.lit("en"))


@pytest.mark.parametrize("topic, ids", [
    ("all_articles", "1 2 3 4 5 7"), ("cities", "1"), ("quantum", "1"), ("quantum_computing", "1 7"),
    ("planetary_health", "4"), ("ai", "5"), ("ai_biodiversity", "5"), ("resilience", ""), ("sustainability", "")])
def test_topics(spark, topic, ids):
    found = subset.nodes_query(nodes(spark), subset.topic_named(topic))
    assert sorted(r.id for r in found.collect()) == ids.split()


def test_topic_filter_reaches_the_scan(spark, tmp_path):
    writers.write_table(nodes(spark), str(tmp_path / "n"), partition_by=["publication_year"])
    stored = spark.read.parquet(str(tmp_path / "n"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = subset.nodes_query(stored, subset.topic_named("cities"))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(type_openalex,article)" in plan and "EqualTo(language,en)" in plan
    assert "PartitionFilters: [isnotnull(publication_year" in plan


def test_subset_build_and_validation(spark, tmp_path):
    edges = spark.createDataFrame([("1", "2", 1), ("1", "6", 1)], "from string, to string, weight int")
    topic = subset.topic_named("all_articles")
    assert subset.build(nodes(spark), edges, topic, str(tmp_path), validate_only=True) is None
    assert subset.build(nodes(spark), edges, topic, str(tmp_path)) == {"nodes": 6, "edges": 1}
    with pytest.raises(FileExistsError):
        subset.build(nodes(spark), edges, topic, str(tmp_path))
    with pytest.raises(ValueError, match="lack"):
        subset.validate(topic, nodes(spark).drop("title"), edges)
    with pytest.raises(ValueError, match="after"):
        subset.validate(subset.Topic("t", first_year=2020, last_year=2000), nodes(spark), edges)
    with pytest.raises(KeyError):
        subset.topic_named("nothing")
    with pytest.raises(ValueError, match="nodes_snapshot"):
        subset.sql_subset(nodes(spark), "SELECT 1")
    with pytest.raises(ValueError, match="parameters"):
        subset.sql_subset(nodes(spark), "SELECT id FROM nodes_snapshot -- :year", year=1)
    with pytest.raises(ValueError, match="unique"):
        subset.unique_ids(nodes(spark).union(nodes(spark)))


def test_sql_pair_binds_edges_to_the_written_nodes(spark, tmp_path):
    given = nodes(spark)
    ids = sorted(r.id for r in given.select("id").collect())
    few = ids[:2]
    edges = spark.createDataFrame([(few[0], few[1], 1), (few[0], ids[-1], 1)], "from string, to string, weight int")
    topic = subset.SqlTopic(
        "SELECT id FROM Nodes_Snapshot WHERE id IN (:one, :two) AND 'nodes_query {x}' <> ':none'",
        "SELECT e.* FROM edges_snapshot e JOIN nodes_query a ON a.id = e.from JOIN nodes_query ON nodes_query.id = e.to;")
    args = {"one": few[0], "two": few[1]}
    views = {t.name for t in spark.catalog.listTables()}
    assert subset.build_sql(given, edges, topic, str(tmp_path), args, validate_only=True) is None
    assert not list(tmp_path.iterdir())
    assert subset.build_sql(given, edges, topic, str(tmp_path), args) == {"nodes": 2, "edges": 1}
    assert spark.read.parquet(f"{tmp_path}/edges_query").collect() == edges.limit(1).collect()
    assert {t.name for t in spark.catalog.listTables()} == views
    with pytest.raises(FileExistsError):
        subset.build_sql(given, edges, topic, str(tmp_path), args)
    with pytest.raises(ValueError, match="nodes_query"):
        subset.build_sql(given, edges, subset.SqlTopic(topic.nodes, "SELECT * FROM edges_snapshot -- nodes_query"),
                         str(tmp_path), args, force=True)
    with pytest.raises(AnalysisException):  # a parameter without a value; what was written stays
        subset.build_sql(given, edges, topic, str(tmp_path), {"one": few[0]}, force=True)
    assert spark.read.parquet(f"{tmp_path}/nodes_query").count() == 2


def test_embeddings_are_reused_only_when_complete(spark, tmp_path):
    calls = []

    def compute(ids):
        calls.append(1)
        return ids.select("id", F.array(F.lit(1.0)).alias("embedding"))

    few = spark.createDataFrame([("a",), ("b",)], "id string")
    more = spark.createDataFrame([("a",), ("c",)], "id string")
    path = str(tmp_path / "e")
    for ids in (few, few, more):
        assert writers.reuse_or_compute(spark, ids, path, compute).count() == 2
    assert len(calls) == 2


def test_word_edges_are_those_of_sql(spark):
    """An accented letter ends a word, as in the SQL: Java's own edges would find no word in the first two titles."""
    rows = [(1, "ément éan"), (2, "inè"), (3, "an"), (4, "banal"), (5, "the_x"), (6, None)]
    df = spark.createDataFrame(rows, "id int, title string").withColumn("abstract", F.lit(None).cast("string"))
    pattern = r"\b(the|an|in)\b"
    assert [r.id for r in df.where(subset.title_matches(pattern)).orderBy("id").collect()] == [1, 2, 3]
    assert [r.id for r in df.where(subset.text_matches(pattern)).orderBy("id").collect()] == [1, 2, 3]
    assert [r.id for r in df.where(subset.title_matches(r"\Ban")).orderBy("id").collect()] == [4]
    assert subset.ascii_edges(r"a\\b[\d]\Q\b\E\.") == r"a\\b[\d]\Q\b\E\."


def test_word_places_are_built_without_python_workers(spark, small):
    rows = [(1, "b a b"), (2, ""), (3, None), (4, " a"), (5, "\u00e9 e\u00e9 \u00e9  z")]
    df = spark.createDataFrame(rows, "n int, text string")
    found = derive._with_positions(df, F.split("text", r"\s+"), "at")
    assert found.columns == ["n", "text", "at"]
    assert {r.n: r["at"] for r in found.collect()} == {
        1: {"a": [1], "b": [0, 2]}, 2: {"": [0]}, 3: None, 4: {"": [0], "a": [1]},
        5: {"\u00e9": [0, 2], "e\u00e9": [1], "z": [3]}}
    plan = derive.raw_work_lines(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
