"""Sorting with the blank and direction rules of the list sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartdex.functions.blank import as_column, is_blank
from chartdex.operators.numbering import SortKey, number_rows, sort_keys

# Fixed value: where rows without a date are sorted.
BLANK_DATE = "1900-01-01"


def is_ascending(direction: str | None) -> bool:
    """Blank and ``asc`` ascend, anything else descends."""
    return direction is None or not direction.strip() or direction == "asc"


def multi_order(columns: list[str], directions: list[str]) -> list[SortKey]:
    """Per-column order; nulls come first ascending and last descending."""
    return [SortKey(F.col(c), d.lower() == "asc") for c, d in zip(columns, directions, strict=True)]


def date_desc_order(column: str) -> list[SortKey]:
    """Latest first by text, blank as the blank date."""
    return [SortKey(F.when(is_blank(column), F.lit(BLANK_DATE)).otherwise(F.col(column)), ascending=False)]


def text_order(column: str, direction: str | None = None) -> list[SortKey]:
    """By text, blank as empty text."""
    return [SortKey(F.when(is_blank(column), F.lit("")).otherwise(F.col(column)), is_ascending(direction))]


def in_order(df: DataFrame, order: Sequence[SortKey | Column | str]) -> DataFrame:
    return df.orderBy(*[k.order() for k in sort_keys(order)])


def sort_multi(df: DataFrame, columns: list[str], directions: list[str]) -> DataFrame:
    return in_order(df, multi_order(columns, directions))


def sort_desc_by_date(df: DataFrame, column: str) -> DataFrame:
    return in_order(df, date_desc_order(column))


def sort_by(df: DataFrame, column: str, direction: str | None = None) -> DataFrame:
    return in_order(df, text_order(column, direction))


def sort_ints(values, direction: str | None = None) -> Column:
    """Sort an integer array."""
    return F.sort_array(as_column(values), asc=is_ascending(direction))


def with_rank(df: DataFrame, order: Sequence[SortKey | Column | str], tie_break: str, name: str = "rank") -> DataFrame:
    """Positions of the rows in an order; ties are settled by a unique column."""
    return number_rows(df, [*order, tie_break], name)
