"""Hot keys are split, at thresholds small enough for test data."""

import pytest
from pyspark.sql import functions as F

from fieldatlas.operators import graph, ranking, selection
from fieldatlas.operators.joins import lookup

TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "12",
    "spark.sql.files.maxPartitionBytes": "16k",
    "spark.sql.files.openCostInBytes": "16k",
}


@pytest.fixture()
def tight(spark):
    before = {k: spark.conf.get(k, None) for k in TIGHT}
    for key, value in TIGHT.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_rows(spark, rows=40_000):
    """One key holds half of the rows, spread over many input partitions."""
    key = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 500)
    return spark.range(0, rows, 1, 12).select(key.cast("bigint").alias("k"), F.col("id").alias("v"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_splits_a_hot_key(tight):
    rows = hot_rows(tight)
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = lookup(rows, sizes, "k")
    assert "skew=true" in final_plan(joined)
    assert joined.where("k = 0").select("n").distinct().collect() == [(20_000,)]


def test_plain_join_to_a_grouped_table_would_not_split(tight):
    rows = hot_rows(tight)
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert "skew=true" not in final_plan(rows.join(sizes, "k"))


def test_restrict_splits_a_hot_key(tight):
    rows = hot_rows(tight)
    ids = tight.range(0, 400, 1, 4).select(F.col("id").alias("k"))
    assert "skew=true" in final_plan(selection.restrict(rows, ids, "k"))


def test_group_rank_of_a_hot_key(tight, scratch):
    ranked = ranking.with_group_rank(hot_rows(tight), ["k"], [F.col("v").asc()], "rn", scratch, size_col="n")
    plan = final_plan(ranked)
    assert "skew=true" in plan
    assert ranked.where("k = 0").agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first() == (1, 20_000, 20_000)


def test_sort_partitions_share_a_hot_key(tight, scratch):
    placed = scratch.save(hot_rows(tight).orderBy("k", "v"))
    sizes = [r["count"] for r in placed.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 12 and max(sizes) < 8_000


def test_hub_of_a_star_is_split(tight, scratch):
    star = tight.range(1, 40_000, 1, 12).select(F.col("id").alias("hi"), F.lit(0).cast("bigint").alias("lo"))
    table = scratch.save(star)
    assert "skew=true" in final_plan(graph._large_star(table))
    edges = star.select(F.col("lo").alias("a"), F.col("hi").alias("b"), F.lit(1.0).alias("w"))
    found = graph.connected_components(edges, scratch)
    assert found.agg(F.count(F.lit(1)), F.max("component")).first() == (40_000, 0)
