"""Exact deduplication by content-defined chunk recipes, with DataFrame functions only.

Texts are cut where their content says so, so that equal passages tend to give
equal chunks.  Every distinct chunk is compared once, as a whole, and gets a
64-bit identifier; a document is from then on the ordered list of its chunks'
identifiers, and only such lists are grouped and joined.  Long texts are read
where they lie; what moves of them is each distinct chunk, once a task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldatlas.operators.joins import lookup
from fieldatlas.session import Scratch

# A chunk ends where a word begins with two rarer letters, two common ones and a rarer one: about once in
# a thousand characters of prose, so that after an insertion the cuts soon fall together again.  Chunks have
# 256 to 8,192 characters, the last one of a text fewer.
CHUNK = r"(?s).{256,8186}?[\s\p{IsPunctuation}][^aeinorst\s]{2}[aeinorst]{2}[^aeinorst\s]|.{1,8192}"

Coder = Callable[[Column], Column]

# Tried in turn until one tells all distinct chunks of the corpus apart.
CODERS: tuple[Coder, ...] = (
    lambda chunk: F.xxhash64(F.lit(17), chunk), lambda chunk: F.xxhash64(F.lit(71), chunk),
    lambda chunk: F.sha2(chunk, 256))


def lowered(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are; null as empty.

    ``lower`` would change other letters too, so it sees only runs of ASCII that begin with a capital.
    """
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[A-Z][\x00-\x7F]*|[^A-Z]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda run: F.when((run >= "A") & (run < "["), F.lower(run)).otherwise(run)), "")


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def tells_apart(documents: DataFrame, coder: Coder) -> bool:
    """Whether all distinct chunks, compared as wholes, have different codes."""
    chunks = documents.select(F.explode(_chunks(lowered(F.col("text")))).alias("chunk"))
    distinct = chunks.groupBy(coder(F.col("chunk")).alias("code"), "chunk").agg(F.lit(1).alias("one"))
    return distinct.groupBy("code").count().where("count > 1").isEmpty()


def recipes(documents: DataFrame, scratch: Scratch, coders: Sequence[Coder] = CODERS) -> DataFrame:
    """``doc_id, recipe, text_sha256`` of every row: the ordered, verified identifiers of its chunks."""
    coder = next((c for c in coders if tells_apart(documents, c)), None)
    if coder is None:
        raise ValueError("no coder tells the chunks apart")
    texts = documents.select("doc_id", lowered(F.col("text")).alias("text"))
    return scratch.save(texts.select("doc_id", F.transform(_chunks(F.col("text")), coder).alias("recipe"),
                                     F.sha2("text", 256).alias("text_sha256")))


def deduplicated(documents: DataFrame, scratch: Scratch, coders: Sequence[Coder] = CODERS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    Texts are equal when identical after lower-casing A-Z; the row with the
    largest id of a group stays.  Null and empty texts are one group; texts of
    any length are compared whole.  A row without an id stays only if no row of
    its group has one (then ``keep_id`` is null).  Rows that repeat both id and
    text count one each in ``group_size`` and share the verdict of their id.
    An empty table gives an empty result; other columns of the input play no part.
    """
    found = recipes(documents, scratch, coders)
    groups = found.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return lookup(found, groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def survivors(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns; of rows that repeat id and text, one."""
    key = next(name for name in (f"text_key{k}" for k in range(len(documents.columns) + 1))
               if name not in documents.columns)
    kept = found.where("kept").select("doc_id", F.col("text_sha256").alias(key)).distinct()
    rows = documents.withColumn(key, F.sha2(lowered(F.col("text")), 256)).dropDuplicates(["doc_id", key])
    return lookup(rows, kept, ["doc_id", key], "left_semi").drop(key)
