"""Rows of many key prefixes, of any lengths, in one scan.

Each prefix is known by its first 1, 2, 4, 8, … characters, as many as it has. A row is
looked up by as many leading characters of its own key, for the lengths in use only, and
then the exact key range decides. So the join is one on equal values. Before it, a few
key ranges that together hold all prefixes reach the scan, where a key-sorted table
skips the row groups between them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartdex.functions.keys import RANGE_END, in_prefix_range
from chartdex.sources.scans import ROWKEY

LENGTHS = (0, 1, 2, 4, 8, 16, 32, 64)
#: Key ranges that reach the scan.
RANGES = 32
_LENGTH, _LEAD = "__length", "__lead"


def covering_ranges(prefixes: DataFrame, ranges: int = RANGES) -> list[tuple[str, str]]:
    """At most ``ranges`` half-open key ranges that hold every key of every prefix."""
    ends = prefixes.where(F.col("prefix").isNotNull()).select("prefix", F.concat("prefix", F.lit(RANGE_END)).alias("end"))
    dealt = ends.repartitionByRange(ranges, "prefix").groupBy(F.spark_partition_id())
    return sorted((r["low"], r["high"]) for r in dealt.agg(F.min("prefix").alias("low"), F.max("end").alias("high")).collect())


def _in_ranges(key: Column, ranges: list[tuple[str, str]]) -> Column:
    tests = [(key >= F.lit(low)) & (key < F.lit(high)) for low, high in ranges]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def scan_prefixes(df: DataFrame, prefixes: DataFrame, *columns: str, key: str = ROWKEY) -> DataFrame:
    """A row per prefix and row in its key range, with the column ``prefix``; a repeated prefix counts once."""
    wanted = prefixes.select("prefix").where(F.col("prefix").isNotNull()).distinct()
    length = F.greatest(*[F.when(F.length("prefix") >= n, n) for n in LENGTHS], F.lit(0))
    led = wanted.withColumn(_LENGTH, length).withColumn(_LEAD, F.left("prefix", F.col(_LENGTH)))
    in_use = led.agg(F.collect_set(_LENGTH)).scalar()
    rows = df.select(*dict.fromkeys([key, *(columns or df.columns)])).where(_in_ranges(F.col(key), covering_ranges(wanted)))
    by_length = rows.withColumn(_LENGTH, F.explode(F.array(*[F.lit(n) for n in LENGTHS])))
    looked_up = by_length.where((F.col(_LENGTH) <= F.length(key)) & F.array_contains(in_use, F.col(_LENGTH)))
    looked_up = looked_up.withColumn(_LEAD, F.left(key, F.col(_LENGTH)))
    found = looked_up.join(led, [_LENGTH, _LEAD]).where(in_prefix_range(key, F.col("prefix")))
    return found.drop(_LENGTH, _LEAD)
