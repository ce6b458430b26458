"""Corpus-shaped tables derived from the star-schema test tables.

Orders stand for works, customers for micro, nations for meso and regions for
macro clusters.  Every derivation covers its whole tables and gathers no group:
array cells hold distinct nation or brand names, which are fixed short lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas.operators.joins import lookup

HOME_COUNTRY = "NATION_3"
RECENT_YEAR = 2000
WORK_PREFIX = "https://works.example/"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def work_key(column: str) -> "F.Column":
    return F.concat(F.lit("W"), F.col(column).cast("string"))


def works(spark: SparkSession, folder: str) -> DataFrame:
    """One article row per order, with cluster ids."""
    lines = (
        table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
        .join(table(spark, folder, "part").select("p_partkey", "p_name", "p_brand"),
              F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, folder, "supplier").select("s_suppkey", "s_nationkey"),
              F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "nation").select("n_nationkey", "n_name"),
              F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("l_orderkey")
        .agg(F.concat_ws(" ", F.min("p_name"), F.max("p_name")).alias("title"),
             F.sort_array(F.collect_set("n_name")).alias("countries"),
             F.sort_array(F.collect_set("p_brand")).alias("institutions"))
    )
    home = table(spark, folder, "customer").select("c_custkey", "c_nationkey").join(
        table(spark, folder, "nation").select("n_nationkey", "n_regionkey"),
        F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        .join(home, F.col("o_custkey") == F.col("c_custkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            work_key("o_orderkey").alias("id"), "title",
            F.lit(None).cast("string").alias("abstract"),
            F.when(F.col("o_orderkey") % 50 != 0, F.floor(F.col("o_totalprice") / 5000)).alias("citations"),
            "countries", "institutions",
            F.col("o_custkey").alias("micro_cluster"),
            F.col("c_nationkey").cast("bigint").alias("meso_cluster"),
            F.col("n_regionkey").cast("bigint").alias("macro_cluster"),
            F.when(F.col("o_orderkey") == 0, 1990).otherwise(F.year("o_orderdate")).alias("publication_year"))
    )


def faulty_works(spark: SparkSession, folder: str) -> DataFrame:
    """Works whose hierarchy has missing and contradictory parents."""
    number = F.substring("id", 2, 20).cast("bigint")
    return works(spark, folder).withColumns({
        "meso_cluster": F.when(F.col("micro_cluster") % 17 != 0, F.col("meso_cluster")),
        "macro_cluster": F.when(number % 101 == 0, (F.col("macro_cluster") + 1) % 5)
                          .otherwise(F.col("macro_cluster"))})


def citations(spark: SparkSession, folder: str) -> DataFrame:
    """Each line item makes its order cite the work numbered like its part."""
    return table(spark, folder, "lineitem").select(
        work_key("l_orderkey").alias("from"), work_key("l_partkey").alias("to"),
        F.lit(1).alias("weight"))


def numeric_citations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"),
        F.lit(1.0).alias("weight"))


def opening_citations(spark: SparkSession, folder: str) -> DataFrame:
    """Each order cites the first order of its customer; one component per customer."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    first = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("opening"))
    return (lookup(orders, first, "o_custkey").where("o_orderkey <> opening")
            .select(F.col("o_orderkey").alias("src"), F.col("opening").alias("dst"),
                    F.lit(1.0).alias("weight")))


def lineage_citations(spark: SparkSession, folder: str) -> DataFrame:
    """Opening citations plus links between the openings of a nation, a region and all."""
    orders = (
        table(spark, folder, "orders").select("o_orderkey", "o_custkey")
        .join(table(spark, folder, "customer").select("c_custkey", "c_nationkey"),
              F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation").select("n_nationkey", "n_regionkey"),
              F.col("c_nationkey") == F.col("n_nationkey")))
    first = orders.groupBy("o_custkey", "c_nationkey", "n_regionkey").agg(F.min("o_orderkey").alias("src"))
    nation = first.groupBy("c_nationkey", "n_regionkey").agg(F.min("src").alias("dst"))
    region = nation.groupBy("n_regionkey").agg(F.min("dst").alias("top"))
    world = region.agg(F.min("top").alias("root"))
    up = (first.join(nation, ["c_nationkey", "n_regionkey"]).select("src", "dst", F.lit(0.5).alias("weight"))
          .unionByName(nation.join(region, "n_regionkey")
                       .select(F.col("dst").alias("src"), F.col("top").alias("dst"), F.lit(0.25).alias("weight")))
          .unionByName(region.withColumn("_one", F.lit(1)).join(world.withColumn("_one", F.lit(1)), "_one")
                       .select(F.col("top").alias("src"), F.col("root").alias("dst"), F.lit(0.1).alias("weight"))))
    return opening_citations(spark, folder).unionByName(up.where("src <> dst"))


def _with_positions(df: DataFrame, words: "F.Column", name: str) -> DataFrame:
    """Add a map of each word of a row to its places from 0, built inside the row from one sorted array."""
    size = F.size("_placed")
    word = lambda at: F.col("_placed")[at - 1]["word"]
    starts = F.filter(F.sequence(F.lit(1), size), lambda at: (at == 1) | (word(at) != word(F.greatest(at - 1, F.lit(1)))))
    runs = F.transform("_starts", lambda at, i: F.struct(word(at), F.slice(
        "_placed", at, F.coalesce(F.get("_starts", i + 1), size + 1) - at)["place"]))
    return (df.withColumn("_placed", F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("place")))))
            .withColumn("_starts", F.when(size > 0, starts))
            .withColumn(name, F.map_from_entries(runs)).drop("_placed", "_starts"))


def raw_work_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as nested JSON lines, one raw work each, in a column ``value``."""
    docs = table(spark, folder, "documents").hint("rebalance")
    code = F.upper(F.substring("source", 1, 2))
    institution = F.struct(F.col("source").alias("display_name"), code.alias("country_code"),
                           F.concat(F.lit("ror/"), F.col("source")).alias("ror"),
                           F.lit("archive").alias("type"))
    second = F.struct(F.concat(F.lit("dept "), F.col("lang")).alias("display_name"),
                      F.upper("lang").alias("country_code"),
                      F.concat(F.lit("ror/"), F.col("lang")).alias("ror"),
                      F.lit("school").alias("type"))
    person = lambda name, *where: F.struct(
        F.struct(name.alias("display_name")).alias("author"), F.array(*where).alias("institutions"))
    number = F.col("doc_id").cast("string")
    work = F.struct(
        F.concat(F.lit(WORK_PREFIX + "W"), number).alias("id"),
        F.concat(F.lit("10.1000/"), number).alias("doi"),
        F.substring_index("text", ".", 1).alias("title"),
        F.col("lang").alias("language"),
        F.lit("article").alias("type"), F.lit("journal-article").alias("type_crossref"),
        F.col("positions").alias("abstract_inverted_index"),
        (F.lit(1990) + F.col("doc_id") % 37).cast("int").alias("publication_year"),
        F.col("n_chars").alias("cited_by_count"),
        F.array(F.concat(F.lit(WORK_PREFIX + "W"), F.floor(F.col("doc_id") / 2).cast("string")),
                F.concat(F.lit(WORK_PREFIX + "W"), F.floor(F.col("doc_id") / 3).cast("string")),
                F.lit("")).alias("referenced_works"),
        F.struct(F.struct(F.col("source").alias("display_name")).alias("source")).alias("primary_location"),
        F.array(person(F.concat(F.lit("Author "), number), institution, second),
                person(F.lit(None).cast("string"), second)).alias("authorships"))
    return (_with_positions(docs, F.split("text", r"\s+"), "positions")
            .select(F.to_json(work).alias("value")))


def document_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as node rows: the text's first sentence as title, the text as abstract."""
    return table(spark, folder, "documents").select(
        work_key("doc_id").alias("id"), F.substring_index("text", ".", 1).alias("title"),
        F.col("text").alias("abstract"), F.col("lang").alias("language"),
        F.lit("article").alias("type_openalex"), F.col("n_chars").alias("citations"),
        F.col("source").alias("publication_source"),
        (F.lit(1990) + F.col("doc_id") % 37).cast("int").alias("publication_year"))

