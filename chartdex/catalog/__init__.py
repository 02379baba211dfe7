"""Every operator as a query over the driver tables, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """All queries, and the SQL of those that have one, by name."""
    from chartdex.catalog import dates, filters, lookups, refresh, reshape, scans, sorting, tables, text, wide_scans
    from chartdex.catalog.registry import ORACLES, QUERIES

    assert all((scans, tables, filters, reshape, lookups, refresh, sorting, dates, text, wide_scans))
    return dict(QUERIES), dict(ORACLES)
