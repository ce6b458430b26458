"""Choosing clusters, and the codes and display ids they get."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldatlas.functions.codes import code_order, is_valid_code
from fieldatlas.functions.numbers import as_id, as_number
from fieldatlas.functions.text import clean
from fieldatlas.operators.ranking import with_group_rank, with_position
from fieldatlas.session import Scratch

# The columns a rule may name.
RULE_COLUMNS = ("publications", "ave_citations", "median_citations", "yearly_rank_citations",
                "ave_py", "median_py", "recency_py", "japan_count")
_RULE = re.compile(r"\s*(?P<column>[a-z_]+)\s*(?P<sign>[<>])=\s*(?P<bound>-?\d+(\.\d+)?)\s*")


@dataclass(frozen=True)
class Rule:
    """A lower or upper bound on one report column."""

    column: str
    at_least: bool
    bound: float

    def condition(self) -> Column:
        """True where the bound holds; a value that is no number fails."""
        number = as_number(F.col(self.column))
        held = number >= self.bound if self.at_least else number <= self.bound
        return F.coalesce(held, F.lit(False))


def parse_rule(text: str) -> Rule:
    found = _RULE.fullmatch(text)
    if found is None:
        raise ValueError(f"rule {text!r} is not of the form column>=value or column<=value")
    if found["column"] not in RULE_COLUMNS:
        raise ValueError(f"rule column {found['column']!r} is not one of {', '.join(sorted(RULE_COLUMNS))}")
    return Rule(found["column"], found["sign"] == ">", float(found["bound"]))


def apply_rules(report: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that satisfy every rule."""
    lacking = [r.column for r in rules if r.column not in report.columns]
    if lacking:
        raise ValueError(f"report has no column {', '.join(lacking)}")
    return report.where(reduce(lambda a, b: a & b, [r.condition() for r in rules], F.lit(True)))


def rule_counts(report: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows left after each rule in turn, from one pass."""
    steps, held = [F.count(F.lit(1)).alias("all_rows")], F.lit(True)
    for at, rule in enumerate(rules, 1):
        held = held & rule.condition()
        steps.append(F.count_if(held).alias(f"after_rule_{at}"))
    return report.agg(*steps)


def at_least(report: DataFrame, size: int) -> DataFrame:
    return report.where(as_number(F.col("publications")) >= size)


def restrict(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the ids.

    The ids are not made distinct first: a semi join ignores copies, and ids
    left as they are keep a hot key of ``df`` open to being split.
    """
    return df.join(ids.select(key).where(F.col(key).isNotNull()), key, "left_semi")


def cosine_scores(centroids: DataFrame, query: Iterable[float], key: str = "micro_cluster",
                  vector: str = "embedding") -> DataFrame:
    """Inner product of unit centroids with one query vector."""
    wanted = F.array(*[F.lit(float(x)) for x in query])
    product = F.zip_with(vector, wanted, lambda a, b: a.cast("double") * b)
    score = F.aggregate(product, F.lit(0.0), lambda total, x: total + x)
    return centroids.select(key, score.alias("similarity"))


def most_similar(scores: DataFrame, n: int = 10) -> DataFrame:
    """The top of the similarity distribution, for choosing a threshold."""
    return scores.orderBy(F.col("similarity").desc(), scores.columns[0]).limit(n)


# --- codes -----------------------------------------------------------------

def cluster_codes(report: DataFrame, scratch: Scratch) -> DataFrame:
    """Codes 'm-k': rank of the macro by total size, rank of the micro inside it."""
    base = scratch.save(
        report.select(as_id(F.col("micro_cluster")).alias("micro_cluster"),
                      as_id(F.col("macro_cluster")).alias("macro_cluster"),
                      as_number(F.col("publications")).alias("p"))
        .where("micro_cluster is not null and macro_cluster is not null")
        .groupBy("micro_cluster", "macro_cluster").agg(F.coalesce(F.max("p"), F.lit(0.0)).alias("p")))
    macros = with_position(base.groupBy("macro_cluster").agg(F.sum("p").alias("p")),
                           [F.col("p").desc(), F.col("macro_cluster").asc()], "_macro_rank", scratch)
    micros = with_group_rank(base, ["macro_cluster"], [F.col("p").desc(), F.col("micro_cluster").asc()],
                             "_micro_rank", scratch)
    code = F.concat_ws("-", (F.col("_macro_rank") + 1).cast("string"), F.col("_micro_rank").cast("string"))
    return micros.join(macros.select("macro_cluster", "_macro_rank"), "macro_cluster") \
                 .select("micro_cluster", "macro_cluster", code.alias("cluster_code"))


def with_cluster_codes(report: DataFrame, scratch: Scratch, keep_valid: bool = False) -> DataFrame:
    """Add ``cluster_code``; clusters without a macro get ''. Well-formed codes may be kept."""
    fresh = cluster_codes(report, scratch).withColumnsRenamed(
        {"cluster_code": "_fresh", "micro_cluster": "_micro", "macro_cluster": "_macro"})
    joined = report.join(fresh, (as_id(F.col("micro_cluster")) == F.col("_micro"))
                         & (as_id(F.col("macro_cluster")) == F.col("_macro")), "left")
    code = clean(F.col("_fresh"))
    if keep_valid and "cluster_code" in report.columns:
        old = clean(F.col("cluster_code"))
        code = F.when(is_valid_code(old), old).otherwise(code)
    return joined.withColumn("cluster_code", code).drop("_fresh", "_micro", "_macro")


def with_display_ids(report: DataFrame, key: str, scratch: Scratch, tie_break: str | None = None,
                     name: str = "display_id") -> DataFrame:
    """Number clusters from 1 by size, then the tie-break metric, then id."""
    order = [as_number(F.col("publications")).desc_nulls_last()]
    if tie_break and tie_break in report.columns:
        order.append(as_number(F.col(tie_break)).desc_nulls_last())
    placed = with_position(report, [*order, F.col(key).asc()], "_pos", scratch)
    return placed.withColumn(name, F.col("_pos") + 1).drop("_pos")


def sort_by_code(df: DataFrame, level: str, *extra: Column) -> DataFrame:
    """Order by the numbers in the code, malformed codes last, then the extra keys."""
    return df.orderBy(*code_order(F.col("cluster_code"), level == "micro"), *extra)


def sort_by(df: DataFrame, column: str, ascending: bool = True) -> DataFrame:
    """Order by any one column, in either direction; equal values by the other columns (maps have no order), ascending."""
    if column not in df.columns:
        raise KeyError(f"no column {column!r}")
    others = [F.col(c).asc_nulls_last() for c, kind in df.dtypes if c != column and "map<" not in kind]
    return df.orderBy(F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_last(), *others)
