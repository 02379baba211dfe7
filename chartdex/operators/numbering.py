"""Consecutive row numbers over a whole table without a single-task window and without stored rows.

The table is cut into buckets by borders, which are rows of a sample in the wanted order.
Rows are counted per bucket, the counts are summed up bucket by bucket (as many rows as
there are buckets), and each bucket numbers its own rows. The borders are drawn by a
subquery of the same plan, so building a query starts no job and writes nothing; since
the order is total, other borders give the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartdex.functions.blank import as_column

_KEY, _BUCKET, _BEFORE, _ROW, _BORDERS, _CUT = "__key", "__bucket", "__before", "__row", "__borders", "__cut"
#: Sampled rows per border; buckets differ by about a fifth in size.
SAMPLES_PER_BUCKET = 32


@dataclass(frozen=True)
class SortKey:
    """A column in an order; nulls are the smallest values unless said otherwise."""

    column: Column
    ascending: bool = True
    nulls_first: bool | None = None

    @property
    def nulls_come_first(self) -> bool:
        return self.ascending if self.nulls_first is None else self.nulls_first

    def order(self) -> Column:
        if self.ascending:
            return self.column.asc_nulls_first() if self.nulls_come_first else self.column.asc_nulls_last()
        return self.column.desc_nulls_first() if self.nulls_come_first else self.column.desc_nulls_last()


def sort_keys(order: Sequence[SortKey | Column | str]) -> list[SortKey]:
    """Plain columns ascend."""
    return [k if isinstance(k, SortKey) else SortKey(as_column(k)) for k in order]


def key_of(keys: Sequence[SortKey]) -> Column:
    """The values an order looks at, as one struct."""
    return F.struct(*[k.column.alias(f"k{i}") for i, k in enumerate(keys)])


def precedes(keys: Sequence[SortKey], left: Column, right: Column) -> Column:
    """Does ``left`` stand strictly before ``right``? Both are structs of ``key_of``."""
    # structs compare field by field, null first: one comparison where all keys go that way or the other
    if all(k.ascending and k.nulls_come_first for k in keys):
        return left < right
    if not any(k.ascending or k.nulls_come_first for k in keys):
        return left > right
    before = F.lit(False)
    for i, k in reversed(list(enumerate(keys))):
        a, b = left[f"k{i}"], right[f"k{i}"]
        earlier = F.when(a.isNull(), F.lit(k.nulls_come_first)).when(b.isNull(), F.lit(not k.nulls_come_first))
        before = F.when(a.eqNullSafe(b), before).otherwise(earlier.otherwise(a < b if k.ascending else a > b))
    return before


def _bucket_count(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _borders(df: DataFrame, keys: Sequence[SortKey], buckets: int) -> Column:
    """Up to ``buckets - 1`` keys in order, as a subquery: quantiles of a sample of bounded size."""
    drawn = df.select(key_of(keys).alias(_KEY)).orderBy(F.xxhash64(_KEY)).limit(SAMPLES_PER_BUCKET * buckets)

    def compare(a: Column, b: Column) -> Column:
        return F.when(precedes(keys, a, b), -1).when(precedes(keys, b, a), 1).otherwise(0)

    n = F.size(_KEY)
    # each border from the sample in order; a small sample repeats some, which leaves buckets empty
    picked = F.transform(F.sequence(F.lit(1), F.lit(buckets - 1)), lambda i: F.get(F.col(_KEY), (i * n / F.lit(buckets)).cast("int")))
    sample = drawn.agg(F.collect_list(_KEY).alias(_KEY)).select(F.array_sort(_KEY, compare).alias(_KEY))
    return sample.select(F.when(n > 0, picked).alias(_BORDERS)).scalar()


def _in_buckets(df: DataFrame, keys: Sequence[SortKey]) -> DataFrame:
    """Rows with their key, the borders, and their bucket: how many borders do not stand after the key.

    A bisection, one step after the other: each looks at one border and moves behind it or
    stays. The step is written once, as a fold over the widths: one expression per step would
    let the optimizer put each into the next, and the plan would grow with a power of the buckets.
    """
    buckets = _bucket_count(df)
    widths = F.array(*[F.lit(1 << bit) for bit in reversed(range((buckets - 1).bit_length()))])

    def place(key: Column) -> Column:
        def step(at: Column, width: Column) -> Column:
            border = F.get(_BORDERS, at + width - 1)
            # no border: past the last one
            return at + F.when(border.isNotNull() & ~precedes(keys, key, border), width).otherwise(0)

        return F.aggregate(widths, F.lit(0), step)

    keyed = df.select("*", key_of(keys).alias(_KEY), _borders(df, keys, buckets).alias(_BORDERS))
    # over an array of one key, so that the key is computed once and not in every comparison
    placed = keyed.withColumn(_BUCKET, F.get(F.transform(F.array(_KEY), place), F.lit(0)))
    return placed.select(*df.columns, _KEY, _BORDERS, _BUCKET)


def _sums_before(counts: DataFrame, within: list[str]) -> DataFrame:
    """Per bucket (and group) the rows of earlier buckets; there are few rows to sum."""
    earlier = Window.partitionBy(*within).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(_BEFORE, F.coalesce(F.sum("count").over(earlier), F.lit(0))).drop("count")


def number_rows(df: DataFrame, order: Sequence[SortKey | Column | str], name: str = "row_no", start: int | Column = 1) -> DataFrame:
    """Number rows consecutively in the given order, which must be a total one.

    Besides the rows themselves only the columns of the order are read, twice: for the
    borders and for the counts.
    """
    keys = sort_keys(order)
    placed = _in_buckets(df, keys).drop(_BORDERS)
    before = _sums_before(placed.groupBy(_BUCKET).count(), [])
    own = F.row_number().over(Window.partitionBy(_BUCKET).orderBy(*[k.order() for k in keys]))
    # every bucket has its row here; an inner join would test the bucket for null, deep in the scan
    numbered = placed.withColumn(_ROW, own).join(F.broadcast(before), _BUCKET, "left")
    return numbered.select(*df.columns, (F.col(_BEFORE) + F.col(_ROW) + F.lit(start) - 1).alias(name))


def number_within(df: DataFrame, group: list[str], order: Sequence[SortKey | Column | str], name: str = "row_no") -> DataFrame:
    """Number rows from 1 within each group, in a total order, whatever the group sizes.

    A group of any size stays spread over the buckets. Only groups that a border falls
    into go on from one bucket to the next, so only their rows are counted: at most two
    such groups a bucket.
    """
    keys = sort_keys([F.col(g) for g in group] + sort_keys(order))
    placed = _in_buckets(df, keys)

    def same_group(border: Column) -> Column:
        same = F.lit(True)
        for i in range(len(group)):
            same = same & border[f"k{i}"].eqNullSafe(F.col(_KEY)[f"k{i}"])
        return border.isNotNull() & same

    at_border = same_group(F.get(_BORDERS, F.col(_BUCKET) - 1)) | same_group(F.get(_BORDERS, F.col(_BUCKET)))
    placed = placed.withColumn(_CUT, F.coalesce(at_border, F.lit(False))).drop(_BORDERS)
    cut_groups = [F.when(F.col(_CUT), F.col(g)).alias(g) for g in group]
    cut = placed.groupBy(_BUCKET, *cut_groups).agg(F.count_if(_CUT).alias("count")).where("count > 0")
    before = _sums_before(cut, group).select(F.col(_BUCKET).alias("__b"), *[F.col(g).alias(f"__{g}") for g in group], _BEFORE)
    own = F.row_number().over(Window.partitionBy(_BUCKET, *group).orderBy(*[k.order() for k in keys[len(group) :]]))
    numbered = placed.withColumn(_ROW, own)
    matches = F.col(_BUCKET) == F.col("__b")
    for g in group:
        matches = matches & F.col(g).eqNullSafe(F.col(f"__{g}"))
    joined = numbered.join(F.broadcast(before), matches, "left")
    return joined.select(*df.columns, (F.coalesce(_BEFORE, F.lit(0)) + F.col(_ROW)).cast("bigint").alias(name))
