"""Texts that contain any pattern of a table, by an index of the patterns' grams.

Every pattern is filed under one of its grams of ``GRAM`` characters, the one that the
fewest patterns have; a shorter pattern under itself. A text is looked up by its own
grams, and what it meets is verified on the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartdex.functions.blank import as_column
from chartdex.operators.joins import first_by_key

GRAM = 3


def _grams(text: Column, size: int | Column) -> Column:
    """The distinct grams of a size, none if the text is shorter; of size 0 the empty one."""
    size = F.lit(size) if isinstance(size, int) else size
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substr(text, i, size)))


def pattern_index(patterns: DataFrame) -> DataFrame:
    """(gram, pattern): each distinct pattern under its rarest gram."""
    distinct = patterns.select("pattern").where(F.col("pattern").isNotNull()).distinct()
    size = F.least(F.length("pattern"), F.lit(GRAM))
    grams = distinct.select("pattern", F.explode(_grams(F.col("pattern"), size)).alias("gram"))
    counted = grams.join(grams.groupBy("gram").count(), "gram")
    return first_by_key(counted, ["pattern"], [F.asc("count"), F.asc("gram")]).select("gram", "pattern")


def patterns_in(texts: DataFrame, patterns: DataFrame, text: str, key: str = "id") -> DataFrame:
    """(key, pattern) of every pattern that a text contains; ``key`` is unique among the texts."""
    index = pattern_index(patterns)
    sizes = index.agg(F.collect_set(F.length("gram"))).scalar()
    body = texts.select(as_column(key).alias("__key"), F.col(text).alias("__text")).where(F.col("__text").isNotNull())
    looked_up = None
    for size in range(GRAM + 1):
        part = body.where(F.array_contains(sizes, F.lit(size))).select("__key", F.explode(_grams(F.col("__text"), size)).alias("gram"))
        looked_up = part if looked_up is None else looked_up.union(part)
    met = looked_up.join(index, "gram").select("__key", "pattern")
    held = met.join(body, "__key").where(F.contains("__text", "pattern"))
    return held.select(F.col("__key").alias(key), "pattern")


def contains_any(texts: DataFrame, patterns: DataFrame, text: str, key: str = "id") -> DataFrame:
    """The rows whose text contains a pattern of the table, as ``inlike`` does with a list."""
    return texts.join(patterns_in(texts, patterns, text, key).select(key).distinct(), key, "left_semi").select(*texts.columns)
