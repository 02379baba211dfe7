"""Helpers of the training-data operators: shared folder, cut lineage, text expressions."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators between words, as a regular expression class without brackets.
SPACE = r"\x20\x09-\x0D"
#: The same characters themselves.
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD = rf"[^{SPACE}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Workspace:
    """A new folder under ``spark.checkpoint.dir`` for the tables one call writes.

    All executors share that folder, so a table written there survives the loss of
    any of them and is never computed twice. Without the setting (as in tests) a
    folder beside the warehouse is used on a local master; a cluster must name one.
    """

    def __init__(self, spark: SparkSession, name: str):
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-checkpoint"
        self.spark = spark
        self.path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def cut(self, df: DataFrame, name: str, partition_by: str | None = None, codec: str | None = None) -> DataFrame:
        """Write a table once and read it again: its lineage ends here."""
        path, schema = f"{self.path}/{name}", df.schema
        writer = df.write.mode("error")
        writer = writer.option("compression", codec) if codec else writer
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def release(self) -> None:
        """Let Spark remove the shuffle files of finished steps, which it does once the driver has collected their plans."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hash_pair(*cols: Column) -> tuple[Column, Column]:
    """128 bits over the columns as two longs; nulls are skipped, so mark them where they matter."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(0x5DEECE66D).cast("bigint"), *cols)


def row_key(*cols: Column) -> tuple[Column, Column]:
    """128 bits that tell rows apart by content; a null differs from every value."""
    marked = [x for c in cols for x in (c.isNull(), c)]
    return hash_pair(*marked)


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def let(value: Column, body) -> Column:
    """``body`` applied to a value that is computed once per row, also if used inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_lines(text: Column) -> Column:
    """The lines of a text; null or empty: one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)
