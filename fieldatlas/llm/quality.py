"""Quality rules whose cutoffs follow each language and source.

Every measure of every document goes into a mergeable quantile sketch: counts of
logarithmic buckets, so that a quantile's relative error is below one per cent
and merging is adding counts in any order.  Sketches of one language and source
give its cutoffs; where a source is small the merged sketch of its language
serves, and the one of all documents where that is small too.  The cutoffs are
then joined to the measures.  Only DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldatlas.operators.joins import lookup
from fieldatlas.session import Scratch

SPACES = r"[\x20\x09-\x0D]+"
GAMMA = 1.02       # width of a bucket
LEAST_ROWS = 200   # documents that a sketch needs to speak for its group
REACH = 4.0        # cutoffs lie this many times the distance from the median to the 10 % or 90 % quantile away
MIN_WORDS = 50
_ZERO = -(1 << 30)  # bucket of values that are not positive
# measure: extra distance from the median that is never cut, whether low values are cut too
MEASURES = {"symbol_share": (0.02, False), "dup_line_share": (0.1, False), "repeat_share": (0.1, False),
            "mean_word": (1.0, True)}


def _windows(words: Column) -> Column:
    """Hashes of all runs of three words."""
    n = F.size(words)
    hashes = F.transform(F.slice(words, F.lit(1), F.greatest(n - 2, F.lit(0))),
                         lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n >= 3, hashes).otherwise(F.array().cast("array<long>"))


def measured(documents: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns, the counts of every whole text and the four measures; null texts have no words."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(*keep, text.alias("_text")) \
        .withColumn("_words", F.array_remove(F.split("_text", SPACES), "")) \
        .withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))) \
        .select(*keep, "_words", F.size("_words").cast("long").alias("n_words"),
                F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
                F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                F.size("_lines").alias("_n_lines"),
                (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines")) \
        .withColumn("_windows", _windows(F.col("_words"))).drop("_words")
    # only texts with a repeated window sort their windows with positions
    placed = F.when(F.size("_windows") > F.size(F.array_distinct("_windows")), F.sort_array(F.transform(
        "_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.withColumn("_placed", placed).drop("_windows")
    same = F.sort_array(F.transform(F.filter("_placed", lambda x, j: F.coalesce(
        x["h"] == F.get("_placed", j - 1)["h"], F.lit(False)) | F.coalesce(
        x["h"] == F.get("_placed", j + 1)["h"], F.lit(False))), lambda x: x["i"]))
    rows = rows.withColumn("_starts", same).drop("_placed")
    gaps = F.transform("_starts", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_starts", j + 1) - p, F.lit(3))))
    rows = rows.withColumn("n_repeat_words", F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, x: a + x), F.lit(0))
                           .cast("long")).drop("_starts")
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return rows.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("n_symbols", "word_chars").alias("symbol_share"), share("n_dup_lines", "_n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"), share("word_chars", "n_words").alias("mean_word"),
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"))


def sketches(rows: DataFrame, by: list[str]) -> DataFrame:
    """Bucket counts ``measure, bucket, n`` of every group."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES])
    long = rows.select(*by, F.explode(pairs).alias("_x")).select(*by, "_x.measure", "_x.value")
    bucket = F.when(F.col("value") > 0, F.ceil(F.log("value") / F.log(F.lit(GAMMA)))).otherwise(F.lit(_ZERO))
    return long.groupBy(*by, "measure", bucket.cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser groups."""
    return sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def cutoffs(sketch: DataFrame, by: list[str]) -> DataFrame:
    """``low`` and ``high`` of each measure, one row a group, where the group is large enough."""
    group = Window.partitionBy(*by, "measure")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = sketch.withColumn("_upto", F.sum("n").over(upto)).withColumn("_all", F.sum("n").over(group))

    def quantile(q: float) -> Column:
        at = F.min(F.when(F.col("_upto") >= q * F.col("_all"), F.col("bucket")))
        return F.when(at == _ZERO, 0.0).otherwise(2 * F.pow(F.lit(GAMMA), at) / (GAMMA + 1))

    per = rows.groupBy(*by, "measure").agg(quantile(0.1).alias("q10"), quantile(0.5).alias("q50"),
                                           quantile(0.9).alias("q90"), F.max("_all").alias("rows"))
    columns = []
    for name, (extra, both) in MEASURES.items():
        mine = F.col("measure") == name
        columns.append(F.max(F.when(mine, F.col("q50") + REACH * (F.col("q90") - F.col("q50")) + extra))
                       .alias(f"high_{name}"))
        if both:
            columns.append(F.max(F.when(mine, F.col("q50") - REACH * (F.col("q50") - F.col("q10")) - extra))
                           .alias(f"low_{name}"))
    return per.where(F.col("rows") >= LEAST_ROWS).groupBy(*by).agg(*columns)


def judged(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """Counts and measures of every row, ``base_failed`` and ``kept``.

    Documents that fail the base rules are no part of the sketches.  Null
    languages and sources are groups of their own.  Where even all documents are
    too few for a sketch, nothing but the base rules applies.
    """
    rows = scratch.save(measured(documents, ["doc_id", "lang", "source"]))
    fine = scratch.save(sketches(rows.where(~F.col("base_failed")), ["lang", "source"]))
    limits = [f"high_{m}" for m in MEASURES] + [f"low_{m}" for m, (_, both) in MEASURES.items() if both]
    groups = fine.select("lang", "source").distinct()
    rename = lambda df, p: df.withColumnsRenamed({c: f"{p}{c}" for c in limits})
    every = rename(cutoffs(merged(fine, []).withColumn("all", F.lit(1)), ["all"]), "c_")
    table = lookup(groups, rename(cutoffs(fine, ["lang", "source"]), "a_"), ["lang", "source"], "left")
    table = lookup(table, rename(cutoffs(merged(fine, ["lang"]), ["lang"]), "b_"), ["lang"], "left")
    table = lookup(table.withColumn("all", F.lit(1)), every, ["all"], "left").select(
        "lang", "source", *[F.coalesce(f"a_{c}", f"b_{c}", f"c_{c}").alias(c) for c in limits])
    held = lookup(rows, table, ["lang", "source"], "left")
    fits = ~F.col("base_failed")
    for name, (_, both) in MEASURES.items():
        fits = fits & F.coalesce(F.col(name) <= F.col(f"high_{name}"), F.lit(True))
        if both:
            fits = fits & F.coalesce(F.col(name) >= F.col(f"low_{name}"), F.lit(True))
    return held.withColumn("kept", fits).drop(*limits)
