import statistics

import pytest
from pyspark.sql import functions as F

from fieldatlas.operators import reports, sampling, selection
from fieldatlas.plans import institution, keywords, migrate, subquery
from fieldatlas.sources import writers

ARTICLES = [
    # id, citations, countries, institutions, micro, meso, macro, year
    ("a", 5, ["JP"], ["U"], 1, 10, 100, 2024), ("b", 5, ["FR", "JP"], ["U", "V"], 1, 10, 100, 2024),
    ("c", None, None, None, 1, 10, 100, 2024), ("d", 9, [], [], 2, 10, 100, 2020),
    ("e", 1, ["FR", None], ["V"], 3, 11, 101, 2024), ("f", 2, ["FR"], ["U"], None, None, None, 2024)]


@pytest.fixture(scope="module")
def articles(spark):
    schema = ("id string, citations bigint, countries array<string>, institutions array<string>, micro_cluster bigint, "
              "meso_cluster bigint, macro_cluster bigint, publication_year int")
    return spark.createDataFrame(ARTICLES, schema).withColumn("title", F.concat(F.lit("T "), "id")) \
        .withColumn("abstract", F.lit(None).cast("string"))


@pytest.fixture(scope="module")
def levels(articles):
    return reports.cluster_reports(articles)


def test_micro_report(levels):
    rows = {r.micro_cluster: r for r in levels["micro"].collect()}
    one, two, three = rows[1], rows[2], rows[3]
    assert (one.publications, one.min_citations, one.ave_citations, one.median_citations) == (3, 5, 5.0, 5)
    # 2024 without the unclustered work: citations 1, 5, 5, null -> ranks 0, 1/3, 1/3, 1
    assert one.yearly_rank_citations == pytest.approx(round((1 / 3 + 1 / 3 + 1) / 3, 4))
    assert two.yearly_rank_citations == 0.5 and three.yearly_rank_citations == 0.0
    assert (one.japan_count, one.recency_py, two.recency_py) == (2, 1.0, 0.0)
    assert (one.meso_cluster, one.macro_cluster) == (10, 100)


def test_upper_reports_count_children(levels):
    meso = {r.meso_cluster: r for r in levels["meso"].collect()}
    macro = {r.macro_cluster: r for r in levels["macro"].collect()}
    assert meso[10].micro_clusters == 2 and meso[11].micro_clusters == 1
    assert (macro[100].meso_clusters, macro[100].micro_clusters, macro[100].publications) == (1, 2, 4)


def test_reports_agree_with_plain_python_on_a_hot_cluster(spark):
    rows = [(i % 97 if i % 9 else None, 1 if i % 3 else i, 2000 + i % 4) for i in range(2000)]
    df = spark.createDataFrame(rows, "citations bigint, micro_cluster bigint, publication_year int") \
        .withColumns({"meso_cluster": F.lit(1).cast("bigint"), "macro_cluster": F.lit(1).cast("bigint"),
                      "countries": F.array().cast("array<string>")})
    got = {r.micro_cluster: r for r in reports.cluster_report(df, "micro").collect()}[1]
    mine = [r for r in rows if r[1] == 1]
    cites = [c for c, _, _ in mine if c is not None]
    assert got.publications == len(mine) and got.median_citations == statistics.median_low(cites)
    assert got.ave_citations == pytest.approx(sum(cites) / len(cites), abs=0.006)


def test_unknown_level(articles):
    with pytest.raises(ValueError):
        reports.cluster_report(articles, "nano")


def test_entities_keep_null_elements(articles):
    got = {(r.micro_cluster, r.country): r.freq for r in
           reports.entity_stats(articles, "micro_cluster", "countries", "country", 20).collect()}
    assert got == {(1, "JP"): 2, (1, "FR"): 1, (3, "FR"): 1, (3, None): 1, (None, "FR"): 1}


def test_audits_are_clean_or_not(articles):
    clean = reports.consistency_audit(articles, "micro").first().asDict()
    assert clean.pop("micro_total") == 3 and not any(clean.values())
    broken = articles.withColumn("macro_cluster", F.when(F.col("id") == "b", 101).otherwise(F.col("macro_cluster")))
    assert reports.consistency_audit(broken, "micro").first()["micro_with_multiple_macro"] == 1
    assert [r.micro_cluster for r in reports.inconsistent_clusters(broken, "micro").collect()] == [1]
    assert reports.coverage_audit(articles).first()["docs_null_micro"] == 1


def test_codes_display_ids_and_sort(spark, scratch):
    rep = spark.createDataFrame(
        [(1, 7, 5.0, 0.1), (2, 7, 9.0, 0.2), (3, 8, 20.0, 0.3), (4, None, 3.0, None), (5, 7, 5.0, 0.9)],
        "micro_cluster bigint, macro_cluster bigint, publications double, yearly_rank_citations double")
    coded = scratch.save(selection.with_cluster_codes(rep, scratch))
    codes = {r.micro_cluster: r.cluster_code for r in coded.collect()}
    assert codes == {3: "1-1", 2: "2-1", 1: "2-2", 5: "2-3", 4: ""}
    kept = selection.with_cluster_codes(rep.withColumn("cluster_code", F.when(F.col("micro_cluster") == 1, "9-9")
                                                       .otherwise("0-1")), scratch, keep_valid=True)
    assert {r.micro_cluster: r.cluster_code for r in kept.collect()} == codes | {1: "9-9"}
    shown = selection.with_display_ids(rep, "micro_cluster", scratch, "yearly_rank_citations")
    assert [r.micro_cluster for r in shown.orderBy("display_id").collect()] == [3, 2, 5, 1, 4]
    text = spark.createDataFrame([("10-1",), ("2-10",), ("2-9",), ("",), (None,)], "cluster_code string")
    assert [r[0] for r in selection.sort_by_code(text, "micro").collect()][:3] == ["2-9", "2-10", "10-1"]


def test_rules(spark):
    rep = spark.createDataFrame([(1, 10.0, "5"), (2, 3.0, "7"), (3, None, "x"), (4, 11.0, None)],
                                "micro_cluster bigint, publications double, ave_py string")
    rules = [selection.parse_rule(" publications >= 10"), selection.parse_rule("ave_py<=6.5")]
    assert [r.micro_cluster for r in selection.apply_rules(rep, rules).collect()] == [1]
    assert tuple(selection.rule_counts(rep, rules).first()) == (4, 2, 1)
    for bad in ("publications>10", "title>=1", "publications>=x"):
        with pytest.raises(ValueError):
            selection.parse_rule(bad)
    with pytest.raises(ValueError, match="no column"):
        selection.apply_rules(rep, [selection.parse_rule("recency_py>=0")])


def test_subquery_export(articles, levels, scratch, tmp_path):
    chosen, matches = subquery.by_filters(levels, ["publications>=1", "ave_py>=2021"], scratch, min_size=1)
    tables = subquery.subsets(chosen, matches, levels, articles)
    counts = subquery.export(tables, str(tmp_path))
    assert set(counts) == set(subquery.SUBSETS)
    assert (counts["matches"], counts["article_top10"], counts["cluster_report_macro"]) == (2, 4, 2)
    assert subquery.summary(*[tables[f"cluster_report_{x}"] for x in ("micro", "meso", "macro")]).first().papers == 4
    found = subquery.profile(tables, 1)
    assert [r.title for r in found["titles"].collect()] == ["T a", "T b", "T c"]
    assert [r.country for r in found["countries"].collect()] == ["JP", "FR"]
    assert [r.micro_cluster for r in subquery.children(chosen, "macro", 101).collect()] == [3]
    assert [r.micro_cluster for r in subquery.overview(chosen).collect()] == [1, 3]


def test_topic_selection(spark, levels, scratch):
    centroids = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.0, 1.0])],
                                      "micro_cluster bigint, embedding array<float>")
    chosen, matches = subquery.by_topic(levels, centroids, [1.0, 0.0], scratch, threshold=0.5, min_size=1)
    assert [r.micro_cluster for r in matches.collect()] == [1, 2]
    assert subquery.overview(chosen, matches).first().micro_cluster == 1
    _, all_matches = subquery.everything(levels, scratch)
    assert [r.micro_cluster for r in all_matches.collect()] == [1, 2, 3]


def test_institution(articles, levels, scratch):
    twice = articles.union(articles.where("id = 'a'"))
    summary = scratch.save(institution.cluster_summary(levels["micro"], twice, "U", scratch))
    row = summary.first()
    assert (row.micro_cluster, row.publications_own, row.pct_own) == (1, 2, 0.6667)
    assert [r.id for r in institution.top_works(summary, twice, "U").collect()] == ["a", "b"]


def test_representatives_share_and_floor(spark, scratch):
    rows = [(f"x{i:04d}", 1, i) for i in range(701)] + [(f"y{i}", 2, i) for i in range(3)]
    df = spark.createDataFrame(rows, "id string, micro_cluster bigint, citations bigint").withColumn("title", F.lit("t"))
    got = keywords.representatives(df, scratch).groupBy("micro_cluster").count()
    assert dict(got.collect()) == {1: 8, 2: 3}


def largest_remainder(sizes, limit):
    """Straight reading of the rule in floating point free integers."""
    total, groups = sum(sizes.values()), len(sizes)
    if total <= limit:
        return dict(sizes)
    seats, room = limit - groups, total - groups
    take = {k: 1 + seats * (n - 1) // room for k, n in sizes.items()}
    rest = sorted(sizes, key=lambda k: (-(seats * (sizes[k] - 1) % room), -sizes[k], k))
    for k in [k for k in rest if sizes[k] > 1][:limit - sum(take.values())]:
        take[k] += 1
    return take


@pytest.mark.parametrize("sizes, limit", [({1: 50, 2: 1, 3: 7, 4: 7}, 20), ({1: 3, 2: 4}, 9), ({5: 1000, 6: 1}, 2)])
def test_allocation(spark, scratch, sizes, limit):
    df = spark.createDataFrame(list(sizes.items()), "k bigint, n_docs bigint")
    got = {r.k: r["take"] for r in sampling.allocate(df, "k", limit, scratch).collect()}
    assert got == largest_remainder(sizes, limit) and sum(got.values()) == min(limit, sum(sizes.values()))


def test_sample_needs_a_seat_per_stratum(spark, scratch):
    df = spark.createDataFrame([(1, 5), (2, 5)], "k bigint, n_docs bigint")
    with pytest.raises(ValueError):
        sampling.allocate(df, "k", 1, scratch)


def test_thresholds_and_sizes(spark):
    rep = spark.createDataFrame([(1, 5), (2, 10), (3, None)], "micro_cluster bigint, publications bigint")
    rows = {r.threshold: r for r in reports.threshold_stats(rep, "micro", [4, 5, 100]).collect()}
    assert rows[4].clusters_above_threshold == 2 and rows[5].pct_clusters_above_threshold == 33.33
    assert reports.threshold_stats(rep.limit(0), "micro", [1]).first().pct_clusters_above_threshold == 0.0


def test_migration(spark, tmp_path):
    root = str(tmp_path)
    clusters = spark.createDataFrame([(1, 11, 21, 31), (2, 12, 21, 31)],
                                     "node_id bigint, micro_cluster bigint, meso_cluster bigint, macro_cluster bigint")
    writers.write_table(clusters, f"{root}/first")
    migrate.point_to(spark, root, "first")
    plan = migrate.migrate(spark, root, "v2", "r0", dry_run=True)
    assert plan["projected"]["distinct_micro"] == 1 and migrate.live_folder(spark, root) == "first"
    done = migrate.migrate(spark, root, "v2", "r1")
    assert migrate.live_folder(spark, root) == "run_id=r1" and done["archive"] == "first"
    live = spark.read.parquet(f"{root}/run_id=r1")
    assert sorted((r.micro_cluster, r.micro_cluster_original) for r in live.collect()) == [(21, 11), (21, 12)]
    with pytest.raises(RuntimeError, match="already promoted"):
        migrate.migrate(spark, root, "v3", "r2")
    migrate.migrate(spark, root, "v3", "r3", force=True)
    again = spark.read.parquet(f"{root}/run_id=r3")
    assert sorted(r.micro_cluster_original for r in again.collect()) == [11, 12]
    migrate.point_to(spark, root, "first")
    assert migrate.live_folder(spark, root) == "first"
    writers.write_table(clusters.limit(0), f"{root}/none")
    migrate.point_to(spark, root, "none")
    with pytest.raises(RuntimeError, match="empty"):
        migrate.migrate(spark, root, "v2")


def test_equal_values_sort_by_the_other_columns(spark):
    rows = [(i, float(i % 2)) for i in (8, 3, 5, 0, 7, 2, 9, 4, 1, 6)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(5)
    assert [r.k for r in selection.sort_by(df, "v", ascending=False).collect()] == [1, 3, 5, 7, 9, 0, 2, 4, 6, 8]
