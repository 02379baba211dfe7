"""Counts over derived groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartdex.functions.dates import age_band


def age_band_count(df: DataFrame, birthday: str, target_day) -> DataFrame:
    """Rows per age band."""
    banded = df.select(age_band(birthday, target_day).alias("band"))
    return banded.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
