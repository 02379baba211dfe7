"""Joins that stay splittable when one key is very frequent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_KEY = "__join_key"


def join_by(left: DataFrame, right: DataFrame, keys: list[str], how: str, hashed: bool = False) -> DataFrame:
    """Join on equal keys, two nulls being equal; the key columns of ``left`` are kept.

    Adaptive execution splits a frequent key over tasks only where both sides enter
    the join straight from a shuffle. A side aggregated by the same columns is
    already partitioned by them and would not, so the join runs on a struct of the
    columns, by which no side is partitioned yet. ``hashed`` builds a hash table of a
    partition of ``right``, which then has to have few rows per key, instead of sorting both.
    """
    packed = F.struct(*keys).alias(_KEY)
    others = [c for c in right.columns if c not in keys]
    other = right.select(packed, *others)
    return left.withColumn(_KEY, packed).join(other.hint("shuffle_hash") if hashed else other, _KEY, how).drop(_KEY)


def matching(left: DataFrame, keys: DataFrame, key: str, present: bool = True, aggregated: bool = False) -> DataFrame:
    """Rows whose key is, or is not, in a key table; a null key is in no table.

    The join runs on the plain column, which keeps bucketing and runtime filters of
    stored tables; ``aggregated`` packs it, for keys that were aggregated by it.
    """
    how = "left_semi" if present else "left_anti"
    known = keys.where(F.col(key).isNotNull()).select(key)
    return join_by(left, known, [key], how) if aggregated else left.join(known, key, how)


def first_by_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in an order; the order settles ties.

    A rank of one limits every group on the map side already, so a task hands on one
    row per key, and whole rows are never packed into an aggregation buffer.
    """
    rank = "__rank"
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) == 1).drop(rank)
