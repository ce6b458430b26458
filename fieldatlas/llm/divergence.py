"""Divergence audit of sources: which sources of a language differ, and by which terms.

Counts of terms are folded in the tasks that read the texts.  The leading terms
of a group come from k-skybands: a term is dropped where at least k others have
no lower count in the group, no higher count in the language and an earlier
name, because each of these ranks before it.  Every partition keeps its own
skyband, skybands merge to skybands, and what remains is ranked by exact values.
Pairs of sources are summed over the terms that both hold; terms that one or
both lack are settled from histograms of counts.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldatlas.llm import bytewords as bw
from fieldatlas.llm.frames import arrow_map
from fieldatlas.operators.joins import lookup
from fieldatlas.session import Scratch

LEAST_DOCUMENTS = 10  # a language keeps the terms of at least so many of its documents
TOP_TERMS = 10
UNIT = 1_000_000_000
MERGE_PARTS = 8       # tasks that merge the skybands of one group

_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")  # every byte of a non-ASCII character is 0x80 or more
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# --- counts -------------------------------------------------------------------

def _count(batch: pa.RecordBatch) -> Iterator[dict]:
    for part in bw.pieces(batch, "text"):
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for lang, source, text in zip(*(part.column(k).to_pylist() for k in ("lang", "source", "text")), strict=True):
            terms = _TERM.findall(text.encode().translate(_LOWER))
            n, documents = found.setdefault((lang, source), (Counter(), Counter()))
            n.update(terms)
            documents.update(set(terms))
        for (lang, source), (n, documents) in found.items():
            yield {"lang": [lang] * len(n), "source": [source] * len(n),
                   "term": pa.array(n.keys(), pa.binary()).cast(pa.string()),
                   "n": pa.array(n.values(), pa.int64()), "documents": pa.array((documents[t] for t in n), pa.int64())}


def term_counts(texts: DataFrame) -> DataFrame:
    """``lang, source, term, n, documents``: occurrences of each term, and documents that hold it."""
    parts = arrow_map(texts.select("lang", "source", "text"),
                      "lang string, source string, term string, n long, documents long", _count)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def share(count: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 * kinds)), exact."""
    wide = "decimal(20,0)"
    over = F.lit(UNIT).cast("decimal(10,0)") * (count + 2).cast(wide)
    return F.call_function("div", over, (total + 2 * kinds).cast(wide)) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)), exact: shares stay below about UNIT."""
    return F.call_function("div", (p - q) * (p - q), p + q)


# --- skybands -----------------------------------------------------------------

class Skyband:
    """Terms of one group, given by falling group count, then rising language count, then name.

    Whatever dominates a term comes before it, so one pass decides.  For each
    language count held, the k earliest names at or below it are kept: a term is
    dominated k times exactly if k such names are earlier than its own.
    """

    def __init__(self, k: int):
        self.k = k
        self.counts: list[int] = []
        self.names: list[list[bytes]] = []

    def admits(self, count: int, name: bytes) -> bool:
        """Whether fewer than k terms dominate this one, which is then held."""
        at = bisect_right(self.counts, count) - 1
        if at >= 0 and len(self.names[at]) == self.k and self.names[at][-1] < name:
            return False
        if at < 0 or self.counts[at] != count:
            self.names.insert(at + 1, list(self.names[at]) if at >= 0 else [])
            self.counts.insert(at + 1, count)
            at += 1
        for names in self.names[at:]:
            if len(names) == self.k and names[-1] < name:
                break  # higher counts hold earlier names still
            insort(names, name)
            del names[self.k:]
        return True


def _skybands(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, band = None, Skyband(k)
        for batch in batches:
            keep = []
            names = batch.column("term").cast(pa.binary()).to_pylist()
            for lang, source, count, name in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "lang_n")),
                                                 names, strict=True):
                if (lang, source) != group:
                    group, band = (lang, source), Skyband(k)
                keep.append(band.admits(count, name))
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def skyband(rows: DataFrame, k: int) -> DataFrame:
    """Rows ``lang, source, term, n, lang_n`` that fewer than k rows of their group and partition dominate."""
    order = ["lang", "source", F.col("n").desc(), "lang_n", "term"]
    return rows.sortWithinPartitions(*order).mapInArrow(_skybands(k), rows.schema)


def leading_terms(kept: DataFrame, groups: DataFrame, k: int = TOP_TERMS) -> DataFrame:
    """``lang, source, item, value, rank``: the k terms that raise a group most above its language."""
    own = skyband(kept.select("lang", "source", "term", "n", "lang_n"), k)
    some = F.pmod(F.xxhash64("term"), F.lit(MERGE_PARTS))
    merged = skyband(own.repartition("lang", "source", some), k)
    rows = lookup(merged, groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("kinds")), share(F.col("lang_n"), F.col("lang_total"), F.col("kinds"))
    valued = rows.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q") \
                 .select("lang", "source", "item", gap(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return valued.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# --- pairs --------------------------------------------------------------------

def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value, rank``: all other sources of the language by their summed gaps.

    Over all kept terms t the sum of gap(p(t), q(t)) is that of terms in neither
    group, plus what each group's own terms change, plus what terms in both
    change beyond that; only the last needs a join, by term.
    """
    none = F.when(F.col("kinds") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kinds")))
    groups = groups.withColumn("none", none)
    held = lookup(kept.select("lang", "source", "term", "n"), groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("kinds")).alias("p"), "none")

    x = held.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("none").alias("za"))
    y = held.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("none").alias("zb"))
    pa_, za, pb, zb = (F.col(c) for c in ("pa", "za", "pb", "zb"))
    both = x.join(y, ["lang", "term"]).where("a < b").groupBy("lang", "a", "b").agg(
        F.sum(gap(pa_, pb) - gap(pa_, zb) - gap(za, pb) + gap(za, zb)).alias("change"))
    both = both.unionAll(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "change"))

    pairs = groups.select("lang", F.col("source").alias("a"), F.col("none").alias("za"), "kinds").join(
        groups.select("lang", F.col("source").alias("b"), F.col("none").alias("zb")), "lang").where("a <> b")
    counts = held.groupBy("lang", F.col("source").alias("a"), F.col("p").alias("pa")).agg(F.count(F.lit(1)).alias("terms"))
    single = counts.join(pairs, ["lang", "a"]).groupBy("lang", "a", "b").agg(
        F.sum(F.col("terms") * (gap(pa_, zb) - gap(za, zb))).alias("change"))
    changes = both.unionAll(single).unionAll(single.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "change"))
    base = pairs.select("lang", "a", "b", F.coalesce(F.col("kinds") * gap(za, zb), F.lit(0)).alias("change"))
    sums = base.unionAll(changes).groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item")) \
               .agg(F.sum("change").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return sums.withColumn("rank", F.row_number().over(order))


def audit(documents: DataFrame, scratch: Scratch, least: int = LEAST_DOCUMENTS, k: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: parts ``pair`` and ``term`` for every group of language and source.

    Null text, lang and source count as empty; every row counts as a document,
    repeated ones too.  A group without terms takes part with counts of 0; a
    language that keeps no term gives pairs of value 0 and no terms.  Equal
    values rank by UTF-8.  An empty table gives an empty result; other columns
    of the input play no part, and texts of any length are read whole.
    """
    texts = documents.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = scratch.save(term_counts(texts))
    terms = counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("documents").alias("documents")) \
                   .where(F.col("documents") >= least).drop("documents")
    kept = scratch.save(lookup(counted.drop("documents"), terms, ["lang", "term"]))
    scratch.drop(counted)

    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # a term's count in its language is that of its groups together; it is counted once, at its first source
    kinds = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("lang_n").alias("lang_total"))
    groups = lookup(lookup(texts.select("lang", "source").distinct(), totals, ["lang", "source"], "left"), kinds, "lang", "left")
    groups = scratch.save(groups.fillna(0, ["total", "kinds", "lang_total"]))

    parts = [found.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
             for name, found in (("pair", source_pairs(kept, groups)), ("term", leading_terms(kept, groups, k)))]
    return parts[0].unionAll(parts[1])
