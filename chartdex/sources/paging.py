"""Pages of a search result by cursor: a page is the top of what comes after the last row seen.

Earlier pages are not computed again, as an offset would: the cursor is a predicate, its
first column also a plain comparison that reaches the scan, and each page a top-k. All
pages together are not read that way, as every page would scan the index again: they come
from one sort (``search_pages``), or from one numbering (``all_pages``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from chartdex.operators.filters import FilterSpec, filter_rows
from chartdex.operators.numbering import SortKey, key_of, number_rows, precedes, sort_keys

CURSOR = "cursor"
_NO = "__no"


def _not_before(key: SortKey, value) -> Column:
    """Rows whose first sort value may stand at or after a value; a comparison that scans can use."""
    if value is None:
        return F.lit(True) if key.nulls_come_first else key.column.isNull()
    later = key.column >= F.lit(value) if key.ascending else key.column <= F.lit(value)
    return later if key.nulls_come_first else later | key.column.isNull()


def _matched(index: DataFrame, queries: list[list[FilterSpec]]) -> DataFrame:
    """Of several queries the last one counts."""
    return filter_rows(index, *queries[-1]) if queries else index


def search_after(
    index: DataFrame,
    queries: list[list[FilterSpec]],
    sort: Sequence[SortKey | Column | str],
    fields: list[str],
    rows: int,
    after: Row | None = None,
) -> DataFrame:
    """The ``rows`` matches that come after a cursor, with their cursors; the first ones without it.

    Of several queries the last one counts. The id settles ties, so it has to be unique.
    """
    keys = sort_keys([*sort, "id"])
    own = _matched(index, queries).withColumn(CURSOR, key_of(keys))
    if after is not None:
        kinds = own.schema[CURSOR].dataType
        last = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(after, kinds)])
        own = own.where(_not_before(keys[0], after[0])).where(precedes(keys, last, F.col(CURSOR)))
    page = own.orderBy(*[k.order() for k in keys]).limit(rows)
    return page.select(*(fields or index.columns), CURSOR)


def search_pages(
    index: DataFrame,
    queries: list[list[FilterSpec]],
    sort: Sequence[SortKey | Column | str],
    fields: list[str],
    rows: int,
) -> Iterator[list[Row]]:
    """All matches with their cursors, a page of at most ``rows`` at a time.

    One sort; its partitions reach the driver one after the other, as pages are taken.
    """
    keys = sort_keys([*sort, "id"])
    ordered = _matched(index, queries).withColumn(CURSOR, key_of(keys)).orderBy(*[k.order() for k in keys])
    found = ordered.select(*(fields or index.columns), CURSOR).toLocalIterator()
    while page := list(islice(found, rows)):
        yield page


def all_pages(
    index: DataFrame,
    queries: list[list[FilterSpec]],
    sort: Sequence[SortKey | Column | str],
    fields: list[str],
    rows: int,
    name: str = "page",
) -> DataFrame:
    """All matches with the number of their page, from 0, as a table; one job, whatever the pages."""
    numbered = number_rows(_matched(index, queries), [*sort, "id"], _NO, start=0)
    return numbered.select(*(fields or index.columns), F.call_function("div", F.col(_NO), F.lit(rows)).alias(name))
