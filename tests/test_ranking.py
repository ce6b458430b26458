import random

from pyspark.sql import functions as F

from fieldatlas.operators import ranking
from fieldatlas.session import scratch_folder


def skewed(spark, rows=3000):
    """One key holds most rows; values repeat and some are null."""
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(40)}",
             rng.choice([None, *range(30)]), i) for i in range(rows)]
    data += [(None, 1, rows), (None, 2, rows + 1)]
    return data, spark.createDataFrame(data, "k string, v int, id int").repartition(7)


def test_group_rank_matches_plain_sort(spark, scratch):
    data, df = skewed(spark)
    got = {r["id"]: (r["rn"], r["size"]) for r in ranking.with_group_rank(
        df, ["k"], [F.col("v").desc_nulls_last(), F.col("id").asc()], "rn", scratch, size_col="size").collect()}
    groups = {}
    for k, v, i in data:
        groups.setdefault(k, []).append((v is None, -(v or 0), i))
    for members in groups.values():
        for at, (_, _, i) in enumerate(sorted(members), 1):
            assert got[i] == (at, len(members))


def test_position_is_dense_whatever_the_partitions(spark, scratch):
    _, df = skewed(spark)
    first = {r["id"]: r["p"] for r in ranking.with_position(df, [F.col("id").asc()], "p", scratch).collect()}
    again = {r["id"]: r["p"] for r in ranking.with_position(df.coalesce(1), [F.col("id").asc()], "p", scratch).collect()}
    assert first == again and sorted(first.values()) == list(range(len(first)))


def test_dense_index_sorts_binary_and_skips_null(spark, scratch):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("B",), ("é",), ("a",)], "s string")
    got = {r["s"]: r["i"] for r in ranking.dense_index(df, "s", "i", scratch).collect()}
    assert got == {"B": 0, "a": 1, "b": 2, "é": 3}


def test_top_n_limits_before_the_shuffle(spark):
    _, df = skewed(spark)
    top = ranking.top_n(df, ["k"], [F.col("id").asc()], 3)
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    physical = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    # the limit stands on both sides of the exchange
    assert physical.count("WindowGroupLimit") == 2


def test_percent_rank_lone_row_ties_and_nulls(spark):
    df = spark.createDataFrame([(2000, 5), (2001, 1), (2001, 1), (2001, 3), (2001, None)], "y int, c int")
    got = {(r["y"], r["c"]): r["paper_rank"] for r in ranking.percent_rank_table(df, "y", "c").collect()}
    assert got == {(2000, 5): 0.5, (2001, 1): 0.0, (2001, 3): 2 / 3, (2001, None): 1.0}


def test_group_median_even_odd_null(spark, scratch):
    df = spark.createDataFrame([(1, 4.0), (1, 1.0), (1, None), (2, 3.0), (2, 1.0), (2, 9.0)], "k int, x double")
    got = dict(ranking.group_median(df, ["k"], "x", "m", scratch).collect())
    assert got == {1: 2.5, 2: 3.0}


def test_scratch_uses_the_shared_folder(spark, scratch):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(spark) == folder
    saved = scratch.save(spark.range(5).toDF("x"))
    assert all(f.startswith(f"file://{folder}") or f.startswith(f"file:{folder}") for f in saved.inputFiles())
    scratch.drop(saved)


def test_first_rows_equal_a_full_sort(spark, scratch):
    rng = random.Random(12)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 0, 0, 1, 2, 9])) for i in range(400)]
    takes = [("a", 57), ("b", 1000), (None, 1), ("unknown", 3)]
    df = spark.createDataFrame(rows, "id long, k string, v long")
    wanted = spark.createDataFrame(takes, "k string, take long")
    coarse = F.struct(F.col("v").isNull(), -F.coalesce("v", F.lit(0)))
    found = ranking.first_rows(df, "k", coarse, [F.col("id").asc()], wanted, scratch)
    expected = []
    for key, take in takes:
        expected += sorted((r for r in rows if r[1] == key), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))[:take]
    assert found.columns == df.columns
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    plan = found._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan.lower()


def test_lookup_with_a_column_named_like_its_own_key(spark):
    left = spark.createDataFrame([(1, "x", 7), (1, "y", 8)], "k long, _key_k string, __KEY_k long")
    right = spark.createDataFrame([(1, "r")], "k long, r string")
    from fieldatlas.operators.joins import lookup
    assert sorted(map(tuple, lookup(left, right, "k").collect())) == [(1, "x", 7, "r"), (1, "y", 8, "r")]
