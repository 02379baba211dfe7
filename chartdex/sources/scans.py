"""Projected, filtered, prefix, incremental and SQL reads.

Filters come first and are plain column predicates, then the projection, so both
reach the file scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartdex.functions.keys import in_prefix_range
from chartdex.operators.filters import FilterSpec, combine, filter_rows, specs_from_text
from chartdex.operators.joins import matching

ROWKEY = "rowkey"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _project(df: DataFrame, columns) -> DataFrame:
    """Named columns, blank names skipped, plus the row key where the table has one; no names means all."""
    named = [c for c in columns if c is not None and c.strip()]
    if not named:
        return df
    if ROWKEY in df.columns and ROWKEY not in named:
        named = [ROWKEY, *named]
    return df.select(*named)


def scan_all(df: DataFrame, *columns: str) -> DataFrame:
    return _project(df, columns)


def scan_filtered(df: DataFrame, specs: list[FilterSpec], *columns: str) -> DataFrame:
    return _project(filter_rows(df, *specs), columns)


def scan_filter_list(
    df: DataFrame, specs: list[FilterSpec], mode: str, *columns: str, missing: str = "drop"
) -> DataFrame:
    """Filters joined by AND (``all``) or OR (``any``), with the rule for missing cells given."""
    return _project(df.where(combine(specs, mode, missing, df.schema)), columns)


def incremental_start(as_of: dt.date) -> int:
    """First year to read: this year, in the first quarter last year too."""
    return as_of.year if as_of.month > 3 else as_of.year - 1


def _since_year(df: DataFrame, field: str, year: int) -> Column:
    kind = df.schema[field].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(field) >= F.lit(f"{year:04d}-01-01 00:00:00").cast(kind)
    return F.col(field) >= F.lit(str(year))


def scan_incremental(df: DataFrame, time_field: str | None, *columns: str, as_of: dt.date | None = None) -> DataFrame:
    """Rows since the start year of ``as_of`` (default today); all rows without a time field.

    Text is compared as text; date and timestamp columns by a typed literal, which
    lets the file statistics skip old row groups.
    """
    if time_field is None or not time_field.strip():
        return _project(df, columns)
    year = incremental_start(as_of or dt.date.today())
    return _project(df.where(_since_year(df, time_field, year)), columns)


def scan_prefix(df: DataFrame, prefix: str, specs: list[FilterSpec] = (), *columns: str) -> DataFrame:
    """Rows of a key range in key order; filter columns join the projection."""
    wanted = list(columns)
    if wanted:
        wanted += [s.name for s in specs if s.name not in wanted]
    rows = filter_rows(df.where(in_prefix_range(ROWKEY, prefix)), *specs)
    return _project(rows, wanted).orderBy(ROWKEY)


def scan_prefix_text(df: DataFrame, prefix: str, filters: str, separator: str, *columns: str) -> DataFrame:
    return scan_prefix(df, prefix, specs_from_text(filters, separator), *columns)


def get_by_key(df: DataFrame, value: str, key: str = ROWKEY) -> DataFrame:
    """The whole row of a key."""
    return df.where(F.col(key) == F.lit(value))


def get_by_keys(df: DataFrame, keys: DataFrame, key: str = ROWKEY) -> DataFrame:
    """The whole rows of all keys in a key table."""
    return matching(df, keys, key)


def _as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])


def sql_query(spark: SparkSession, text: str, columns: list[str]) -> DataFrame:
    """Named columns of a SQL text over registered views, as text."""
    return _as_text(spark.sql(text), columns)


def select_table(spark: SparkSession, text: str, table: str) -> DataFrame:
    """As ``sql_query``, the columns being those of a table."""
    return _as_text(spark.sql(text), spark.table(table).columns)


def jdbc_query(spark: SparkSession, url: str, text: str, columns: list[str], **options: str) -> DataFrame:
    """``sql_query`` against a remote database; pass partitioning bounds in ``options`` to read in parallel."""
    return _as_text(spark.read.format("jdbc").options(url=url, query=text, **options).load(), columns)


def search_index(
    index: DataFrame,
    queries: list[list[FilterSpec]],
    sort: list[Column] = (),
    fields: list[str] = (),
    start: int = 0,
    rows: int | None = None,
) -> DataFrame:
    """Index documents in order: all that match, or the page of ``rows`` from ``start``.

    Of several queries the last one counts; none matches everything. The id
    settles ties, so pages do not overlap.
    """
    matched = filter_rows(index, *queries[-1]) if queries else index
    ordered = matched.orderBy(*sort, F.col("id").asc())
    page = ordered.offset(start) if start else ordered
    page = page if rows is None else page.limit(rows)
    return page.select(*fields) if fields else page
