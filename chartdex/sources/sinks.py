"""Batched index writes, key-sorted tables and the XML sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from chartdex.functions.text import map_to_labels
from chartdex.operators.numbering import SortKey, number_rows

# Fixed value: documents per commit.
BATCH_SIZE = 1000


def write_batched(docs: DataFrame, flush: Callable[[list[Row]], None], batch_size: int = BATCH_SIZE) -> None:
    """Hand every partition's documents to ``flush`` in batches, the rest of a partition last.

    ``flush`` runs in the tasks. An error fails the task, and Spark runs it again,
    so ``flush`` should write by id.
    """

    def drain(rows) -> None:
        batch: list[Row] = []
        for row in rows:
            batch.append(row)
            if len(batch) == batch_size:
                flush(batch)
                batch = []
        if batch:
            flush(batch)

    docs.foreachPartition(drain)


def write_batch_files(docs: DataFrame, path: str, batch_size: int = BATCH_SIZE) -> None:
    """The same batches as Parquet files."""
    docs.write.mode("errorifexists").option("maxRecordsPerFile", batch_size).parquet(path)


def number_batches(docs: DataFrame, order: Sequence[SortKey | Column | str], batch_size: int = BATCH_SIZE) -> DataFrame:
    """Give every document its batch in a table-wide order."""
    numbered = number_rows(docs, order, "__no", start=0)
    batch = F.call_function("div", F.col("__no"), F.lit(batch_size))
    return numbered.withColumn("batch_no", batch).drop("__no")


def write_by_key(df: DataFrame, path: str, key: str = "rowkey") -> None:
    """Write a table sorted by key, so that prefix scans skip files and row groups."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("errorifexists").parquet(path)


def write_map_xml(df: DataFrame, entries: str, path: str) -> None:
    """Write a map column as ``<node><key label="k">v</key>…</node>`` records."""
    labelled = df.select(map_to_labels(entries).alias("key"))
    labelled.write.mode("errorifexists").format("xml").option("rootTag", "nodes").option("rowTag", "node").save(path)
