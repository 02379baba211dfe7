"""Registration of queries together with their SQL."""

from __future__ import annotations

from chartdex.plans.views import table

_ZONE = "spark.sql.session.timeZone"
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated ``(spark, sf_dir) -> DataFrame`` under a name."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark, sf_dir):
            # texts with times are written in UTC on both sides; expressions keep the zone they were built in
            zone = spark.conf.get(_ZONE)
            spark.conf.set(_ZONE, "UTC")
            try:
                return fn(spark, sf_dir)
            finally:
                spark.conf.set(_ZONE, zone)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


__all__ = ["ORACLES", "QUERIES", "query", "table"]
