import colorsys
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldatlas.functions import codes, colors, numbers, text
from fieldatlas.operators import vectors
from fieldatlas.plans import charts, enriched, keywords, naming, packs


def values(spark, rows, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_text_functions(spark):
    v = F.col("v")
    assert values(spark, ["w12", "https://x/W9/y", "none", None], text.work_id(v)) == ["W12", "W9", None, None]
    assert values(spark, ["a, deep-sea x,, b", "", None], text.keyword_title(v, 2)) == \
        ["A Deep-Sea X", "Unnamed Cluster", "Unnamed Cluster"]
    assert values(spark, ["it's o'neil-x 3d"], text.title_case(v)) == ["it's o'neil-x 3d".title()]
    assert values(spark, ["x" * 64, "x" * 65, None], text.truncated(v, 64)) == ["x" * 64, "x" * 63 + "...", ""]
    assert values(spark, [" N/A ", "x", None, "NaN"], text.is_blank_like(v)) == [True, False, True, True]
    assert values(spark, ["ieee international usa", "PEOPLES R CHINA"], text.facet_value(v)) == ["IEEE Int. USA", "China"]
    assert values(spark, ["a, b, c", None], text.first_keywords(v, 2)) == ["a, b", ""]


def test_names_from_titles(spark):
    df = spark.createDataFrame([(1, ["the state-of art: a b c d e", " x ", "y", "z"]), (2, []), (3, None), (4, ["…"])],
                               "c bigint, t array<string>")
    rows = {r.c: r for r in df.select("c", text.fallback_name(F.col("c"), F.col("t")).alias("n"),
                                      text.fallback_description(F.col("c"), F.col("t")).alias("d")).collect()}
    assert rows[1].n == "The State-Of Art A B C" and rows[1].d.endswith("works: the state-of art: a b c d e; x; y.")
    assert rows[2].n == "Macro Topic 2" and rows[3].n == "Macro Topic 3" and rows[4].n == "Macro Topic 4"
    assert rows[3].d == "Field of cluster 3 without titled works."


def test_enriched_text(spark):
    df = spark.createDataFrame([("N", "t", "a"), ("N", None, ""), ("", "t", None), (None, "", " ")], "n string, t string, a string")
    got = [r[0] for r in df.select(text.enriched_text(F.col("n"), F.col("t"), F.col("a"))).collect()]
    assert got == ["N. t a", "N", "t", ""]
    got = df.limit(1).select(text.keyword_boosted_text(F.col("t"), F.col("n"), F.col("a"), 2)).first()[0]
    assert got == "t. N. a. N. a."


def test_codes(spark):
    v = F.col("v")
    assert values(spark, ["1-2---", "3-0", "1-05"], codes.clean_code(v)) == ["1-2", "3", "15"]
    assert values(spark, ["1-2---", "3-0"], codes.main_code(v)) == ["1", "3"]
    assert values(spark, ["1-2", "0-1", None, " 4-5 "], codes.is_valid_code(v)) == [True, False, False, True]
    df = spark.createDataFrame([("1", " NaN ", "c"), ("2", "g", "c"), ("3", None, "")], "k string, g string, c string")
    got = [r[0] for r in df.select(codes.display_label(F.col("k"), F.col("g"), F.col("c"))).collect()]
    assert got == ["1. c", "2. g", "3"]


def test_stable_colors_match_hsv(spark):
    got = [r[0] for r in spark.range(60).orderBy("id").select(colors.stable_color(F.col("id"))).collect()]
    for i, found in enumerate(got):
        rgb = colorsys.hsv_to_rgb((i * 0.6180339887498949) % 1.0, 0.62, 0.85)
        assert found == "#" + "".join(f"{int(c * 255):02x}" for c in rgb)


def test_shades_match_hls(spark):
    rng = random.Random(2)
    rows = [("#%06x" % rng.randrange(1 << 24), rng.uniform(0.3, 0.7)) for _ in range(60)] + [("#808080", 0.4)]
    df = spark.createDataFrame(rows, "c string, l double")
    for (base, light), found in zip(rows, df.select(colors.shade(*colors.hue_and_saturation(F.col("c")), F.col("l")).alias("s")).collect()):
        h, _, s = colorsys.rgb_to_hls(*[int(base[i:i + 2], 16) / 255 for i in (1, 3, 5)])
        wanted = [int(round(x * 255)) for x in colorsys.hls_to_rgb(h, light, s)]
        shown = [int(found.s[i:i + 2], 16) for i in (1, 3, 5)]
        assert max(abs(a - b) for a, b in zip(wanted, shown)) <= 1


def test_cluster_colors_grey_and_ramp(spark, scratch):
    df = spark.createDataFrame([(c,) for c in ("1-1", "1-10", "1-2", "2-1", "99")], "cluster_code string")
    got = {r.cluster_code: r for r in charts.cluster_colors(df, ["#1f77b4", "#ff7f0e"], scratch).collect()}
    assert [got[c].lightness for c in ("1-1", "1-10", "1-2")] == pytest.approx([0.3, 0.5, 0.7])
    assert got["2-1"].sub_color == "#ff7f0e" and got["99"].color == colors.GREY
    assert [r[0] for r in spark.range(1, 5).select(
        colors.palette_color(F.col("id"), F.lit(4), ["a", "b"], recycle=True)).collect()] == ["a", "b", "a", colors.GREY]


def test_rounding(spark):
    df = spark.createDataFrame([(0.285,), (1.005,), (0.03125,), (2.5,)], "x double")
    assert [r[0] for r in df.select(numbers.round_to(F.col("x"), 2)).collect()] == [
        math.floor(x * 100 + 0.5) / 100 for x in (0.285, 1.005, 0.03125, 2.5)]
    assert [r[0] for r in df.select(numbers.round_even(F.col("x"), 4)).collect()][2] == 0.0312


def test_class_keywords_by_hand(spark, scratch):
    docs = [("a", "deep sea mining of the sea"), ("a", "sea x mining"), ("b", "deep space"), ("b", None), (None, "sea")]
    df = spark.createDataFrame(docs, "label string, body string")
    counts = defaultdict(Counter)
    for label, body in docs:
        if label and body:
            words = [w for w in body.lower().split() if len(w) > 1 and w not in ("of", "the")]
            counts[label].update(words + [f"{x} {y}" for x, y in zip(words, words[1:])])
    total = sum(counts.values(), Counter())
    mean = sum(total.values()) // len(counts)
    wanted = {}
    for label, found in counts.items():
        size = sum(found.values())
        score = {t: round(math.sqrt(n / size) * math.log(1 + mean / total[t]), 9) for t, n in found.items()}
        wanted[label] = ", ".join(sorted(score, key=lambda t: (-score[t], t))[:10])
    got = dict(keywords.class_keywords(df, "label", "body", scratch, stop_words=["of", "the"]).collect())
    assert got == wanted
    only = dict(keywords.class_keywords(df, "label", "body", scratch, stop_words=["of", "the"], min_df=2).collect())
    assert only == {"a": "deep", "b": "deep"}
    assert "the" in keywords.english_stop_words()


def test_class_keywords_leave_large_classes_spread(spark, scratch):
    docs = spark.range(3000).selectExpr("if(id % 10 = 0, 'a', 'b') AS label",
                                        "concat('w', hex(hash(id)), ' v', hex(hash(id + 7))) AS body")
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, "8k")  # far below the terms, above one row a class
    try:
        plan = keywords.class_keywords(docs, "label", "body", scratch)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set(name, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_weighted_roll_up(spark):
    micro = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "micro_cluster bigint, embedding array<double>")
    meta = spark.createDataFrame([(1, 9, 3, 5), (2, 9, None, 4)],
                                 "micro_cluster bigint, macro_cluster bigint, publications bigint, rep_count bigint")
    row = vectors.rolled_up(micro, meta, "macro").first()
    assert row.embedding == pytest.approx([0.6, 0.8])
    zero = spark.createDataFrame([([0.0, 0.0],)], "v array<float>").select(vectors.unit(F.col("v"))).first()[0]
    assert zero == [0.0, 0.0]


def test_projection_and_encoders(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(a), float(b), 0.0]) for i, (a, b) in enumerate(rng.normal(size=(50, 2)) * [5, 1])]
    df = spark.createDataFrame(rows, "id bigint, embedding array<float>")
    axes = vectors.plane_axes(df)
    assert axes[0, 0] > 0.9 and axes[2, 0] == pytest.approx(0, abs=1e-9)
    got = vectors.on_plane(df, axes).first()
    assert got.x_coords == pytest.approx(float(np.dot(rows[0][1], axes[:, 0])), rel=1e-5)

    texts = spark.createDataFrame([(1, "aa"), (2, None)], "id bigint, t string")
    out = vectors.encoded(texts, "id", "t", lambda: lambda batch: np.array([[len(t), 3.0] for t in batch]), batch=1)
    assert {r.id: [round(x, 3) for x in r.embedding] for r in out.collect()} == {1: [0.555, 0.832], 2: [0.0, 1.0]}
    hashed = vectors.hashed_embeddings(texts, "id", "t", 16).collect()
    assert len(hashed) == 2 and len(hashed[0].embedding) == 16


def test_unique_names_follow_the_sequential_rule(spark, scratch):
    rng = random.Random(3)
    rows = [(i, rng.choice(["Ab", "ab", "AB (4)", "ab (2)", "x", "x (9)"])) for i in range(14)]
    rng.shuffle(rows)
    seen, wanted = set(), {}
    for i, name in sorted(rows):
        if name.lower() in seen:
            name = f"{name} ({i})"
        seen.add(name.lower())
        wanted[i] = name
    df = spark.createDataFrame(rows, "macro_cluster bigint, name string")
    assert dict(naming.unique_names(df, scratch).select("macro_cluster", "name").collect()) == wanted
    exact = dict(naming.unique_names(df, scratch, exact=True).select("macro_cluster", "name").collect())
    counts = Counter(n for _, n in rows)
    assert exact == {i: n if counts[n] == 1 else f"{n} ({i})" for i, n in rows}


def test_names_from_keywords(spark, scratch):
    raw = spark.createDataFrame([(1, "A", 1), (1, "B", 2), (7, "Z", 1)], "macro_cluster bigint, name string, position int")
    expected = spark.createDataFrame([(1,), (2,), (3,)], "macro_cluster bigint")
    words = spark.createDataFrame([(2, "deep sea, x")], "cluster bigint, keywords string")
    got = dict(naming.names_from_keywords(raw, expected, words, scratch).select("macro_cluster", "name").collect())
    assert got == {1: "A", 2: "Deep Sea", 3: "Macro Field 3"}
    assert sorted(map(tuple, naming.coverage(expected, raw).collect())) == [(2, "missing"), (3, "missing"), (7, "unexpected")]


def test_answers(spark):
    rows = [("micro-5", '{"name":"n","short_name":"s","description":"d"}', None), ("micro-6", '{"name":"n"}', None),
            ("micro-7", "no", None), ("micro-8", None, "will not"), ("bad", "{}", None)]
    got = {r.micro_cluster: r for r in naming.parse_answers(spark.createDataFrame(
        rows, "custom_id string, content string, refusal string")).collect()}
    assert got[5].name == "n" and got[5].error is None and got[6].error.startswith("parse")
    assert got[8].error == "refusal: will not" and None in got


def test_backfill_takes_only_blank(spark):
    docs = spark.createDataFrame([("a", " "), ("b", "own"), ("c", None)], "id string, abstract string")
    other = spark.createDataFrame([("a", "two"), ("b", "no"), ("a", "one"), ("c", "")], "id string, abstract string")
    filled = enriched.backfill(docs, [other])
    assert {r.id: r.abstract for r in filled.collect()} == {"a": "one", "b": "own", "c": None}
    assert tuple(enriched.backfill_counts(docs, filled).first()) == (3, 1, 3, 2)


def test_country_names(spark):
    df = spark.createDataFrame([("JP",), ("jp",), (None,), ("Atlantis",), ("TW",)], "country string")
    known = packs.country_table(spark)
    assert known.count() > 200
    got = sorted(r[0] for r in packs.country_names(df, known).collect())
    assert got == ["", "Atlantis", "Japan", "Japan", "Taiwan"]


def test_bars_fill_names_and_cut(spark, scratch):
    rep = spark.createDataFrame(
        [(i, 1 + i % 2, 10.0 + i, 2020.5, 3.0) for i in range(8)] + [(99, 1, 1.0, 2000.0, 0.0)],
        "micro_cluster bigint, macro_cluster bigint, publications double, ave_py double, ave_citations double")
    tint = spark.createDataFrame([(1, "#111111"), (2, " ")], "macro_cluster bigint, color_hex string")
    names = spark.createDataFrame([(7, "long " * 20)], "micro_cluster bigint, short_name string")
    rows = {r.cluster_id: r for r in charts.bar_table(rep, "micro", tint, scratch, names, 5, 2, 1).collect()}
    assert set(rows) == {7, 5, 6, 4} and rows[7].cluster_code == "1-1" and rows[4].panel_id == 2
    assert rows[7].color_hex == colors.CHART_GREY and rows[6].color_hex == "#111111"
    assert len(rows[7].label_text) == 66 and rows[7].label_text.endswith("...")
    points = charts.scatter_table(rep, "micro", tint, scratch, min_x=2010.0, min_y=1.0)
    assert points.count() == 8


def test_level_sheet_prefers_given_names(spark, scratch):
    rep = spark.createDataFrame([(1, 5, "old"), (2, 9, "keep")], "macro_cluster bigint, publications bigint, name string")
    given = spark.createDataFrame([(1, "s", "new", None)], "cluster bigint, short_name string, name string, description string")
    rows = [(r.cluster_code, r.macro_cluster, r.name, r.short_name) for r in
            packs.cluster_sheet(rep, "macro", scratch, given).collect()]
    assert rows == [("1", 2, "keep", ""), ("2", 1, "new", "s")]


def test_pack_and_report_files(spark, scratch, small, tmp_path):
    from fieldatlas import derive
    from fieldatlas.catalog.charts import _clusters
    from fieldatlas.operators import reports
    from fieldatlas.sources.readers import read_optional

    works = scratch.save(derive.works(spark, small))
    found = reports.cluster_reports(works, derive.HOME_COUNTRY, derive.RECENT_YEAR)
    meta = derive.document_nodes(spark, small).select(
        F.col("id").alias("article_id"), F.array("language").alias("authors"), "publication_source", "abstract")
    counts = packs.write_pack(works, found, meta, str(tmp_path), "s", "q", "all", packs.country_table(spark))
    assert counts["macro"] == {"article_report_top20": 100, "cluster_profile": 5}
    info = {r.item: r.value for r in spark.read.csv(f"{tmp_path}/meso/info", header=True).collect()}
    assert info["documents"] == "1500" and info["clusters"] == "25"
    packs.write_report(_clusters(spark, small, scratch), f"{tmp_path}/report")
    totals = spark.read.json(f"{tmp_path}/report/totals").first()
    assert totals.total_publications == 1500 and totals.total_macro_clusters == 5
    assert read_optional(spark, f"{tmp_path}/macro/cluster_profile", "a int").count() == 5
