"""Cluster codes such as '3-12': validity, numeric order and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldatlas.functions.text import blank_to_null, clean

# Fixed value: a well-formed two-part code.
TWO_PART_CODE = r"^\s*([1-9][0-9]*)-([1-9][0-9]*)\s*$"


def is_valid_code(code: Column) -> Column:
    return F.coalesce(clean(code).rlike(r"^[1-9][0-9]*-[1-9][0-9]*$"), F.lit(False))


def code_order(code: Column, two_part: bool) -> list[Column]:
    """Sort keys that compare the numbers in a code; malformed codes come last."""
    if not two_part:
        return [code.try_cast("double").asc_nulls_last()]
    return [F.regexp_extract(code, TWO_PART_CODE, i).try_cast("bigint").asc_nulls_last()
            for i in (1, 2)]


def clean_code(code: Column) -> Column:
    """Drop '---' and '-0' wherever they stand."""
    return F.regexp_replace(code, r"---|-0", "")


def tail_clean_code(code: Column) -> Column:
    """Drop a final '-0', then a final '---'."""
    return F.regexp_replace(F.regexp_replace(code, r"-0$", ""), r"---$", "")


def main_code(code: Column) -> Column:
    """Part before the first dash of the cleaned code."""
    return F.substring_index(tail_clean_code(code), "-", 1)


def known_name(name: Column) -> Column:
    """The trimmed name, or null when it is empty or spelled 'nan'."""
    text = blank_to_null(name)
    return F.when(F.lower(text) != "nan", text)


def display_label(code: Column, global_name: Column, cluster_name: Column,
                  limit: int | None = None) -> Column:
    """'code. name' with the global name first, then the cluster name, then the bare code."""
    shown = tail_clean_code(code)
    name = F.coalesce(known_name(global_name), known_name(cluster_name))
    label = F.coalesce(F.concat(shown, F.lit(". "), name), shown)
    return F.substring(label, 1, limit) if limit else label
