"""Batched writes with a commit: a data source whose tasks hand over batches and whose driver publishes them.

Each task writes its rows in batches of ``batchSize``, a file each, into a folder of its own
and reports the folder. Only when all tasks have ended does the driver publish the
reported folders, by one small list under ``committed``; what failed or repeated attempts
left behind is in no list and is removed. Readers take the folders of the lists.

A write has a name (option ``write``). A write that is run again under its name replaces
what it has published, so a retried job does not double its rows; and ``read_batches``
gives one row per id, that of the latest write, in the order of their names.

The folder may lie in any file system that pyarrow knows by its address.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from chartdex.operators.joins import first_by_key

FORMAT = "chartdex-batches"
# Fixed value: documents per commit.
BATCH_SIZE = 1000


def _file_system(path: str):
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


@dataclass
class TaskFiles(WriterCommitMessage):
    """What one task has written."""

    folder: str
    files: int = 0
    rows: int = 0


class BatchWriter(DataSourceArrowWriter):
    """Tasks write batch files; ``commit`` publishes them, ``abort`` removes them."""

    def __init__(self, path: str, write: str, batch_size: int):
        self.path, self.write_name, self.batch_size = path.rstrip("/"), write, batch_size
        self.staged = f"{self.path}/staged/{write}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> TaskFiles:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        system, folder = _file_system(self.staged)
        task = TaskContext.get()
        folder = posixpath.join(folder, f"{task.partitionId()}-{task.taskAttemptId()}")
        system.create_dir(folder)
        done, held, size = TaskFiles(posixpath.relpath(folder, _file_system(self.path)[1])), [], 0

        def flush() -> None:
            nonlocal size
            table = pa.Table.from_batches(held)
            for start in range(0, table.num_rows - table.num_rows % self.batch_size, self.batch_size):
                put(table.slice(start, self.batch_size))
            rest = table.slice(table.num_rows - table.num_rows % self.batch_size)
            held[:] = rest.to_batches()
            size = rest.num_rows

        def put(batch) -> None:
            pq.write_table(batch, posixpath.join(folder, f"{done.files}.parquet"), filesystem=system)
            done.files += 1
            done.rows += batch.num_rows

        for batch in iterator:
            held.append(batch)
            size += batch.num_rows
            if size >= self.batch_size:
                flush()
        if size:
            put(pa.Table.from_batches(held))
        return done

    def commit(self, messages: list[TaskFiles]) -> None:
        system, root = _file_system(self.path)
        system.create_dir(f"{root}/committed")
        listed, draft = f"{root}/committed/{self.write_name}.json", f"{root}/committed/.{uuid.uuid4().hex}"
        done = [m for m in messages if m is not None and m.files]
        published = {"write": self.write_name, "rows": sum(m.rows for m in done), "folders": [m.folder for m in done]}
        with system.open_output_stream(draft) as out:
            out.write(json.dumps(published).encode())
        system.move(draft, listed)
        self._clear(keep={m.folder for m in done})

    def abort(self, messages: list[TaskFiles]) -> None:
        self._clear(keep=set())

    def _clear(self, keep: set[str]) -> None:
        """Remove the folders of attempts of this run that are not published."""
        from pyarrow import fs

        system, root = _file_system(self.path)
        staged = _file_system(self.staged)[1]
        for found in system.get_file_info(fs.FileSelector(staged, allow_not_found=True)):
            if posixpath.relpath(found.path, root) not in keep:
                system.delete_dir(found.path)


class BatchSource(DataSource):
    """``df.write.format(FORMAT).option("write", name).mode("append").save(path)``"""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("a batch write adds to its folder; use mode append and name the write")
        options = self.options
        return BatchWriter(options["path"], options["write"], int(options.get("batchsize", options.get("batchSize", BATCH_SIZE))))


def save_batches(docs: DataFrame, path: str, write: str, batch_size: int = BATCH_SIZE) -> None:
    """Write documents in batches and publish them together, under the name of this write."""
    docs.sparkSession.dataSource.register(BatchSource)
    docs.write.format(FORMAT).option("write", write).option("batchSize", batch_size).mode("append").save(path)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """(write, rows, folder) of what is published."""
    lists = spark.read.schema("write string, rows bigint, folders array<string>").json(f"{path.rstrip('/')}/committed")
    return lists.select("write", "rows", F.explode("folders").alias("folder"))


def read_batches(spark: SparkSession, path: str, schema: StructType | str, key: str) -> DataFrame:
    """The published documents, one per id: that of the write with the greatest name."""
    root, listed = path.rstrip("/"), committed(spark, path)
    runs = listed.select(F.substring_index("folder", "/", 2).alias("run")).distinct().collect()  # one per write
    if not runs:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f"{root}/{r['run']}/*" for r in runs])
    parts = F.split(F.input_file_name(), "/")
    folder = F.array_join(F.slice(parts, F.size(parts) - 3, 3), "/")
    placed = rows.withColumn("__folder", folder).join(listed, F.col("__folder") == F.col("folder"))
    rest = [c for c in rows.columns if c != key]
    return first_by_key(placed, [key], [F.desc("write"), *[F.asc(c) for c in rest]]).select(*rows.columns)
