"""Nothing is cut before it is counted, and scratch tables and files stay in hand."""

import os

from pyspark.sql import functions as F

from fieldatlas.catalog import all_queries
from fieldatlas.functions import text
from fieldatlas.operators import ranking
from fieldatlas.plans import charts, keywords, packs
from fieldatlas.session import Scratch
from fieldatlas.sources.writers import write_table


def test_rare_terms_count_as_well(spark, scratch):
    """Class b has only terms that come after the 100,000 most frequent ones."""
    many = spark.range(100_000).select(F.lit("a").alias("k"), F.concat_ws(" ", *[
        F.concat(F.lit("t"), F.col("id").cast("string"))] * 2).alias("v"))
    one = spark.createDataFrame([("b", "rare")], "k string, v string")
    got = {r.cluster: r.keywords for r in keywords.class_keywords(many.unionAll(one), "k", "v", scratch,
                                                                  stop_words=()).collect()}
    assert got["b"] == "rare"


def test_top_n_limits_map_tasks_for_large_n(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), "id")
    top = ranking.top_n(df, ["k"], [F.col("id").asc()], 5000)
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert top.count() == 15_000


def test_long_ids_and_facets_stay_apart(spark):
    long = "x" * 600
    df = spark.createDataFrame([(f"p{long}1; u",), (f"p{long}2; u",)], "v string")
    assert df.select(text.strip_prefix(F.col("v"), "p")).distinct().count() == 2
    got = charts.facet_frequency(df, "v").collect()
    assert [r.documents for r in got] == [2, 1, 1] and all(len(r.label) <= 45 for r in got)
    assert spark.createDataFrame([("university of the arts",)], "v string").select(
        text.facet_value(F.col("v"))).first()[0] == "University of the Arts"


def test_scratch_block_leaves_nothing(spark):
    with Scratch(spark) as scratch:
        assert scratch.save(spark.range(3).toDF("x")).count() == 3
        folder = scratch.root.removeprefix("file://").removeprefix("file:")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_partitioned_write_makes_few_files(spark, tmp_path):
    df = spark.range(0, 4000, 1, 16).select("id", (F.col("id") % 8).cast("int").alias("year"))
    assert write_table(df, str(tmp_path / "t"), partition_by=["year"]) == 4000
    assert len(list((tmp_path / "t").glob("year=*/part-*"))) <= 16


def test_entities_are_cut_after_blanks(spark):
    rows = [(1, 10, ["", "nan"], 2000, 1)] * 3 + [(1, 10, ["A", "B"], 2001, 2), (1, 10, ["A"], 2001, 2)]
    articles = spark.createDataFrame(rows, "micro_cluster bigint, macro_cluster bigint, institutions array<string>, "
                                           "publication_year int, citations bigint")
    sheet = spark.createDataFrame([(1, "1-1")], "micro_cluster bigint, cluster_code string")
    got = packs.entity_sheet(articles, sheet, "micro", "institutions", "institution", top=3).collect()
    assert [(r.institution, r.freq) for r in got] == [("nan", 3), ("A", 2), ("B", 1)]


def test_institution_reads_the_works_once(spark, small):
    assert not any("lineitem" in f for f in all_queries()["institution_top10"](spark, small).inputFiles())


def test_payload_reads_the_works_once(spark, small):
    assert not any("lineitem" in f for f in all_queries()["report_payload"](spark, small).inputFiles())
