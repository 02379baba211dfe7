"""A stored index in hash buckets of its key, of which a change rewrites only the touched buckets.

Files are never changed in place. A change reads the buckets of its keys, writes them to a
new folder and then writes a manifest, a table of one file that says where each bucket
lies. Readers follow the latest manifest, so they see a change as a whole or not at all,
and a run that fails before it leaves the old version as it was. Two changes at once
are refused: the second one finds its manifest written.

The manifest has a row per bucket, so the number of buckets bounds what the driver reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET = "__bucket"
_MANIFEST = "bucket int, folder string, schema string, key string, buckets int"


class BucketIndex:
    """The index under a path, at its latest version when opened or after the last change."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        manifest = spark.read.schema(f"{_MANIFEST}, version int").parquet(f"{self.path}/manifest")
        self.version = manifest.agg(F.max("version")).first()[0]
        entries = manifest.where(F.col("version") == self.version).collect()
        first = entries[0]
        self.key, self.buckets = first["key"], first["buckets"]
        self.schema = T.StructType.fromJson(json.loads(first["schema"]))
        self.folders = {r["bucket"]: r["folder"] for r in entries if r["folder"] is not None}

    @classmethod
    def create(cls, path: str, df: DataFrame, key: str, buckets: int) -> BucketIndex:
        """Store a table as the first version."""
        self = cls.__new__(cls)
        self.spark, self.path, self.version = df.sparkSession, path.rstrip("/"), 0
        self.key, self.buckets, self.schema, self.folders = key, buckets, df.schema, {}
        self._commit(self._written(df), touched=set())
        return self

    def bucket_of(self, key: str | Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def read(self, buckets: set[int] | None = None) -> DataFrame:
        """The rows of all buckets, or of some."""
        wanted = [b for b in self.folders if buckets is None or b in buckets]
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folders[b]}/{_BUCKET}={b}" for b in sorted(wanted)])

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys, from their buckets only."""
        return self.read(self.touched(keys)).join(keys.select(self.key).distinct(), self.key, "left_semi")

    def touched(self, changes: DataFrame) -> set[int]:
        """The buckets of the keys of a change table."""
        return {r[0] for r in changes.select(self.bucket_of(self.key)).distinct().collect()}

    def apply(self, change: Callable[[DataFrame, DataFrame], DataFrame], changes: DataFrame) -> set[int]:
        """Replace the touched buckets by ``change(their rows, changes)``; returns them.

        ``change`` is a table function such as ``upsert_by_id`` that only adds, changes
        or removes rows of keys that the change table holds.
        """
        touched = self.touched(changes)
        if touched:
            new = change(self.read(touched), changes)
            self._commit(self._written(new.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])), touched)
        return touched

    def _written(self, rows: DataFrame) -> dict[int, str]:
        """Write rows by bucket into a new folder; a large bucket is spread over tasks and files."""
        folder = f"{self.path}/data/{self.version + 1}-{uuid.uuid4().hex}"
        placed = rows.withColumn(_BUCKET, self.bucket_of(self.key)).hint("rebalance", _BUCKET)
        placed.write.partitionBy(_BUCKET).parquet(folder)
        schema = T.StructType([*self.schema, T.StructField(_BUCKET, T.IntegerType())])
        filled = self.spark.read.schema(schema).parquet(folder).select(_BUCKET).distinct().collect()
        return {r[0]: folder for r in filled}

    def _commit(self, written: dict[int, str], touched: set[int]) -> None:
        folders = {b: f for b, f in self.folders.items() if b not in touched} | written
        schema = self.schema.json()
        entries = [(b, f, schema, self.key, self.buckets) for b, f in folders.items()] or [(None, None, schema, self.key, self.buckets)]
        manifest = self.spark.createDataFrame(entries, _MANIFEST).coalesce(1)
        try:
            manifest.write.mode("errorifexists").parquet(f"{self.path}/manifest/version={self.version + 1}")
        except AnalysisException as error:
            raise RuntimeError(f"version {self.version + 1} of {self.path} was written by another change") from error
        self.version, self.folders = self.version + 1, folders
