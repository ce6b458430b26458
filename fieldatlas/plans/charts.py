"""Tables behind the bar, scatter and map charts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldatlas.functions import text
from fieldatlas.functions.codes import display_label, main_code, tail_clean_code
from fieldatlas.functions.colors import CHART_GREY, GREY, hue_and_saturation, palette_color, ramp_lightness, shade
from fieldatlas.functions.numbers import as_id, as_number, sqrt_scale
from fieldatlas.operators.joins import lookup
from fieldatlas.operators.ranking import first_per_key, group_median, top_n, with_group_rank, with_position
from fieldatlas.operators.reports import child_counts
from fieldatlas.operators.selection import with_cluster_codes
from fieldatlas.session import Scratch
from fieldatlas.sources.readers import pick_column

NAME_COLUMNS = ("short_name", "name", "cluster_name")
RANK_COLUMNS = ("yearly_rank_citations", "ranked_citation_score", "ranked_citation")


def _level_rows(report: DataFrame, level: str, colors: DataFrame, names: DataFrame | None,
                min_size: int, scratch: Scratch, required: tuple[str, ...] = ()) -> DataFrame:
    """Shared core: sized clusters with parent, code, colour and short name."""
    id_column = pick_column(report, (f"{level}_cluster", "cluster"))
    for column in ("publications", *required):
        pick_column(report, (column,))
    name_column = pick_column(report, NAME_COLUMNS, required=False)
    cluster = as_id(F.col(id_column))
    parent = as_id(F.col("macro_cluster")) if level != "macro" and "macro_cluster" in report.columns else cluster
    metrics = [c for c in ("ave_py", "ave_citations") if c in report.columns]
    rank_column = pick_column(report, RANK_COLUMNS, required=False)
    rows = report.select(
        cluster.alias("cluster_id"), F.coalesce(parent, cluster).alias("macro_parent"),
        as_number(F.col("publications")).alias("publications"),
        (text.clean(F.col(name_column)) if name_column else F.lit("")).alias("short_name"),
        (text.clean(F.col("cluster_code")) if "cluster_code" in report.columns else F.lit("")).alias("cluster_code"),
        *[as_number(F.col(c)).alias(c) for c in metrics],
        (as_number(F.col(rank_column)) if rank_column else F.lit(None).cast("double")).alias("rank_metric"))
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("cluster_id", "publications", *required)])
    rows = rows.where(present).withColumn("publications", F.greatest("publications", F.lit(0.0))) \
               .where(F.col("publications") >= min_size)
    rows = first_per_key(rows, ["cluster_id"], [F.col("publications").desc()])

    if level == "micro" and names is not None:
        column = pick_column(names, NAME_COLUMNS, required=False)
        if column:
            given = names.select(as_id(F.col("micro_cluster")).alias("cluster_id"),
                                 text.clean(F.col(column)).alias("_given")) \
                         .where("cluster_id is not null and _given <> ''")
            given = first_per_key(given, ["cluster_id"], [F.col("_given").asc()])
            rows = rows.join(given, "cluster_id", "left").withColumn(
                "short_name", F.when(F.col("short_name") == "", F.coalesce("_given", F.lit("")))
                .otherwise(F.col("short_name"))).drop("_given")
    rows = scratch.save(rows)
    if level == "micro":
        renamed = rows.withColumnsRenamed({"cluster_id": "micro_cluster", "macro_parent": "macro_cluster"})
        coded = with_cluster_codes(renamed, scratch, keep_valid=True).withColumnsRenamed(
            {"micro_cluster": "cluster_id", "macro_cluster": "macro_parent"})
        coded = coded.withColumn("cluster_code", F.coalesce(text.blank_to_null(F.col("cluster_code")),
                                                            F.col("cluster_id").cast("string")))
    else:
        coded = with_position(rows, [F.col("publications").desc(), F.col("cluster_id").asc()], "_pos", scratch) \
            .withColumn("cluster_code", (F.col("_pos") + 1).cast("string")).drop("_pos")

    macros = rows.groupBy("macro_parent").agg(F.sum("publications").alias("_p"))
    macros = with_position(macros, [F.col("_p").desc(), F.col("macro_parent").asc()], "_pos", scratch) \
        .select("macro_parent", (F.col("_pos") + 1).alias("macro_display_id"))
    palette = colors.select(as_id(F.col("macro_cluster")).alias("macro_parent"),
                            text.blank_to_null(F.col("color_hex")).alias("color_hex")) \
                    .where("macro_parent is not null and color_hex is not null")
    palette = first_per_key(palette, ["macro_parent"], [F.col("color_hex").asc()])
    label = F.when(F.col("short_name") == "", F.col("cluster_code")) \
             .otherwise(F.concat_ws(". ", "cluster_code", "short_name"))
    return coded.join(macros, "macro_parent", "left").join(palette, "macro_parent", "left").withColumns({
        "macro_display_id": F.coalesce("macro_display_id", F.lit(0)),
        "color_hex": F.coalesce("color_hex", F.lit(CHART_GREY)), "label_text": label})


def bar_table(report: DataFrame, level: str, colors: DataFrame, scratch: Scratch,
              names: DataFrame | None = None, min_size: int = 0, top_per_parent: int = 10,
              macros_per_panel: int = 5) -> DataFrame:
    """Bars of a level: largest clusters per macro, labels of at most 64 characters, panels."""
    rows = _level_rows(report, level, colors, names, min_size, scratch)
    if level != "macro":
        rows = top_n(rows, ["macro_display_id"],
                     [F.col("publications").desc(), F.col("cluster_id").asc()], top_per_parent)
    return rows.select(
        "cluster_id", "macro_parent", "macro_display_id", "publications", "cluster_code", "color_hex",
        F.col("label_text").alias("label_full"), text.truncated(F.col("label_text"), 64).alias("label_text"),
        (F.floor((F.col("macro_display_id") - 1) / macros_per_panel) + 1).alias("panel_id"))


def scatter_table(report: DataFrame, level: str, colors: DataFrame, scratch: Scratch,
                  names: DataFrame | None = None, min_size: int = 0, y: str = "ave_citations",
                  min_x: float | None = None, min_y: float | None = None) -> DataFrame:
    """Points of a level: mean year against citations or the yearly rank metric."""
    rows = _level_rows(report, level, colors, names, min_size, scratch, ("ave_py", "ave_citations"))
    if min_x is not None:
        rows = rows.where(F.col("ave_py") >= min_x)
    if min_y is not None:
        rows = rows.where(F.col(y) >= min_y)
    return rows.where(F.col(y).isNotNull()).select(
        "cluster_id", "macro_parent", "macro_display_id", "publications", "ave_py", "ave_citations",
        "rank_metric", "cluster_code", "color_hex", "label_text")


def label_anchors(points: DataFrame, keys: list[str], scratch: Scratch, at_least: int = 1,
                  limit: int | None = None) -> DataFrame:
    """Median point and size of each group, largest first."""
    points = scratch.save(points.select(*keys, "x", "y"))
    sizes = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= at_least)
    out = sizes.join(group_median(points, keys, "x", "cx", scratch), keys, "left") \
               .join(group_median(points, keys, "y", "cy", scratch), keys, "left")
    out = out.orderBy(F.col("n_docs").desc(), *keys)
    return out.limit(limit) if limit else out


def map_layers(coords: dict[str, DataFrame], micro_report: DataFrame) -> DataFrame:
    """Points of all three levels with their macro cluster and child-count marker size.

    ``coords[level]`` has cluster, x and y.  Sizes count micro clusters and are
    square-root scaled inside each layer.
    """
    known = micro_report.select("micro_cluster", "meso_cluster", "macro_cluster")
    micro = coords["micro"].join(known.select(F.col("micro_cluster").alias("cluster"), "macro_cluster"),
                                 "cluster", "left").withColumn("size", F.lit(1).cast("bigint"))
    parents = known.groupBy(F.col("meso_cluster").alias("cluster")).agg(F.min("macro_cluster").alias("macro_cluster"))
    sizes = {level: child_counts(known, f"{level}_cluster", "micro_cluster")
             .select(F.col(f"{level}_cluster").alias("cluster"), F.col("micro_clusters").alias("size"))
             for level in ("meso", "macro")}
    meso = coords["meso"].join(parents, "cluster", "left").join(sizes["meso"], "cluster", "left")
    macro = coords["macro"].withColumn("macro_cluster", F.col("cluster")).join(sizes["macro"], "cluster", "left")
    layers = [df.select(F.lit(level).alias("layer"), "cluster", "x", "y", "macro_cluster",
                        F.coalesce("size", F.lit(1)).alias("size"))
              for level, df in (("micro", micro), ("meso", meso), ("macro", macro))]
    rows = reduce(DataFrame.unionByName, layers)
    span = rows.groupBy("layer").agg(F.min("size").alias("_low"), F.max("size").alias("_high"))
    return lookup(rows, span, "layer").withColumn(
        "marker", sqrt_scale(F.col("size"), F.col("_low"), F.col("_high"), 20.0, 400.0)).drop("_low", "_high")


def labelled_points(docs: DataFrame, coords: DataFrame, meta: DataFrame) -> DataFrame:
    """Documents with coordinates and cluster facts; ``matched`` is false without facts.

    ``meta`` has cluster, cluster_code, cluster_name and global_name.
    """
    facts = first_per_key(meta, ["cluster"], [F.col("cluster_code").asc_nulls_last()])
    rows = lookup(docs.join(coords, "id"), facts.withColumn("matched", F.lit(True)), "cluster", "left")
    code = F.coalesce("cluster_code", F.col("cluster").cast("string"))
    return rows.select("id", "cluster", "x", "y", code.alias("cluster_code"), main_code(code).alias("main_cluster"),
                       display_label(code, F.col("global_name"), F.col("cluster_name")).alias("label"),
                       F.coalesce("matched", F.lit(False)).alias("matched"))


def cluster_colors(codes: DataFrame, palette: list[str], scratch: Scratch, recycle: bool = False) -> DataFrame:
    """Palette colour per main cluster and a lightness ramp over its sub-clusters.

    Main clusters are ordered by number, then text; the last one is grey.
    Input is one column ``cluster_code`` of distinct codes.
    """
    rows = codes.select("cluster_code", main_code(F.col("cluster_code")).alias("main_cluster"))

    def numbers_first(column: str) -> list[Column]:
        return [F.col(column).try_cast("bigint").asc_nulls_last(), F.col(column).asc()]

    mains = with_position(rows.select("main_cluster").distinct(), numbers_first("main_cluster"), "_pos", scratch)
    count = mains.count()
    mains = mains.select("main_cluster", palette_color(F.col("_pos") + 1, F.lit(count), palette, recycle).alias("color"))
    hue, saturation = hue_and_saturation(F.col("color"))
    mains = scratch.save(mains.withColumns({"_hue": hue, "_saturation": saturation}))  # one row per main cluster
    shown = tail_clean_code(F.col("cluster_code"))
    ranked = with_group_rank(
        rows, ["main_cluster"],
        [shown.try_cast("bigint").asc_nulls_last(), shown.asc(), F.col("cluster_code").asc()],
        "_rank", scratch, size_col="_size")
    plain = (F.col("color") == GREY) | (F.col("_size") <= 1)
    lightness = ramp_lightness(F.col("_rank"), F.col("_size"))
    found = scratch.save(ranked.join(mains, "main_cluster").withColumn("lightness", F.when(~plain, lightness)))
    shaded = shade(F.col("_hue"), F.col("_saturation"), F.col("lightness"))
    return found.select("cluster_code", "main_cluster", "color", "lightness",
                        F.when(plain, F.col("color")).otherwise(shaded).alias("sub_color"))


def plot_clusters(report: DataFrame, facet: bool = False) -> DataFrame:
    """Leave out the catch-all codes and, for facets, those with fewer than ten documents."""
    code = F.col("cluster_code").cast("string")
    kept = report.where(~code.contains("-99") & (code != "99"))
    return kept.where("documents >= 10") if facet else kept


def facet_frequency(df: DataFrame, column: str, separator: str = "; ") -> DataFrame:
    """Documents per normalised value of a multi-valued text column, most frequent first.

    Whole values are counted; ``label`` has their first 45 characters for display.
    """
    values = df.where(F.col(column).isNotNull()).select(F.explode(F.split(column, separator)).alias("item"))
    return values.groupBy(text.facet_value(F.col("item")).alias("item")) \
                 .agg(F.count(F.lit(1)).alias("documents")) \
                 .select("item", F.substring("item", 1, 45).alias("label"), "documents") \
                 .orderBy(F.col("documents").desc(), "item")


def yearly_counts(df: DataFrame, year: str = "publication_year") -> DataFrame:
    return df.groupBy(as_id(F.col(year)).alias("year")).agg(F.count(F.lit(1)).alias("documents")).orderBy("year")


def recent_years(df: DataFrame, n: int = 10, year: str = "publication_year") -> DataFrame:
    """Documents of the last n years that have any."""
    return yearly_counts(df, year).where("year is not null").orderBy(F.col("year").desc()).limit(n)
