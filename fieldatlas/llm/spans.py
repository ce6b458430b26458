"""Spans found by a search over many documents, brought back to their texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldatlas.operators.joins import lookup


def row_tag() -> Column:
    """Identity of a row: its id and text, so that repeated ids with other texts stay apart."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def with_spans(documents: DataFrame, spans: DataFrame, keep: list[str]) -> DataFrame:
    """Add ``_starts`` and ``_lengths`` (null if none) to every row; ``spans`` has ``tag, start, length``.

    The spans of one row are bounded by its own text.
    """
    per_row = spans.groupBy(F.col("tag").alias("_row_tag")).agg(F.collect_list(F.struct("start", "length")).alias("_spans"))
    texts = documents.select(*keep, row_tag().alias("_row_tag"))
    return lookup(texts, per_row, "_row_tag", "left").select(
        *keep, F.col("_spans.start").alias("_starts"), F.col("_spans.length").alias("_lengths"))
