"""Tables laid out for reads by time: a folder per year, rows in time order inside.

A read since a year lists the folders of that year and later ones only, and inside them
the file statistics skip what is earlier. Text times are laid out by their first four
characters, which compare with a year as the whole text does.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartdex.sources.scans import incremental_start, scan_incremental

YEAR = "year_of_time"


def year_of(df: DataFrame, time_field: str) -> Column:
    if isinstance(df.schema[time_field].dataType, T.StringType):
        return F.left(time_field, F.lit(4))
    return F.lpad(F.year(time_field).cast("string"), 4, "0")


def write_by_time(df: DataFrame, path: str, time_field: str) -> None:
    """Write a table by year and time; a large year is spread over tasks and files."""
    placed = df.withColumn(YEAR, year_of(df, time_field))
    placed.repartitionByRange(YEAR, time_field).sortWithinPartitions(YEAR, time_field).write.partitionBy(YEAR).mode("errorifexists").parquet(path)


def scan_by_time(spark: SparkSession, path: str, time_field: str, *columns: str, as_of: dt.date | None = None) -> DataFrame:
    """As ``scan_incremental`` over a table of ``write_by_time``; folders of earlier years are not listed in the scan."""
    as_of = as_of or dt.date.today()
    stored = spark.read.parquet(path)
    recent = stored.where(F.col(YEAR).cast("string") >= F.lit(f"{incremental_start(as_of):04d}"))
    columns = columns or tuple(c for c in stored.columns if c != YEAR)
    return scan_incremental(recent, time_field, *columns, as_of=as_of)
