"""A stream sink of Parquet files that become visible with the commit of their batch.

Every task writes one file under a name of its own; the commit of a batch writes the list of its files, in one move. A
reader follows the lists, so files of a failed or aborted batch are never seen, and a batch handed over again replaces
its list. Files are reached through ``pyarrow.fs``, so the folder may be in any store that it knows by its URI.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import latest_by_key
from ..session import checkpoint_path

# The writer travels with the query, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "finlake_committed"
DATA, COMMITS = "data", "commits"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class CommittedWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written | None:
        """One file per task that has rows."""
        writer, rows, name = None, 0, f"{uuid.uuid4().hex}.parquet"
        store, root = _store(self.path)
        try:
            for batch in iterator:
                if batch.num_rows:
                    if writer is None:
                        store.create_dir(f"{root}/{DATA}")
                        writer = pq.ParquetWriter(store.open_output_stream(f"{root}/{DATA}/{name}"), batch.schema)
                    writer.write_batch(batch)
                    rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Written(name, rows) if rows else None

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        """The list of the batch's files takes the place of an earlier one; files only the earlier one names go."""
        store, root = _store(self.path)
        store.create_dir(f"{root}/{COMMITS}")
        place = f"{root}/{COMMITS}/{batchId:020d}.json"
        before = []
        if store.get_file_info(place).type == fs.FileType.File:
            before = [json.loads(line)["file"] for line in store.open_input_stream(place).read().splitlines()]
        lines = [json.dumps({"batch_id": batchId, "file": m.file, "rows": m.rows}) for m in messages if m is not None]
        draft = f"{root}/{COMMITS}/.{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            out.write("".join(f"{line}\n" for line in lines).encode())
        store.move(draft, place)
        self._remove(set(before) - {m.file for m in messages if m is not None})

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._remove({m.file for m in messages if m is not None})

    def _remove(self, files: set[str]) -> None:
        store, root = _store(self.path)
        for name in files:
            if store.get_file_info(f"{root}/{DATA}/{name}").type == fs.FileType.File:
                store.delete_file(f"{root}/{DATA}/{name}")


class CommittedFiles(DataSource):
    """``df.writeStream.format(FORMAT).option("path", folder)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> CommittedWriter:
        if overwrite:
            raise ValueError("batches are added; complete mode is not supported")
        return CommittedWriter(self.options["path"])


def committed_stream(
    df: DataFrame, path: str, name: str, *, trigger: str | None = "30 seconds", checkpoint: str | None = None
) -> StreamingQuery:
    """Append a stream to committed files; ``trigger=None`` processes what is there and stops.

    Spark lets such a sink append only; running aggregates go through ``runner.parquet_batches``.
    """
    spark = df.sparkSession
    spark.dataSource.register(CommittedFiles)
    writer = df.writeStream.queryName(name).format(FORMAT).outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint or checkpoint_path(spark, name))
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def read_committed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of all committed batches with their ``batch_id``; no rows where nothing is committed yet."""
    store, root = _store(path.rstrip("/"))
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    none = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())]))
    if store.get_file_info(f"{root}/{COMMITS}").type != fs.FileType.Directory:
        return none
    lists = spark.read.schema("batch_id long, file string, rows long").json(f"{path.rstrip('/')}/{COMMITS}")
    files = [r["file"] for r in lists.select("file").collect()]
    if not files:
        return none
    rows = spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{DATA}/{f}" for f in files])
    named = rows.select("*", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"))
    return named.join(lists.select("file", "batch_id"), "file").drop("file")


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per document id: the one of the newest batch, and within a batch the one last by ``order``."""
    return latest_by_key(read_committed(spark, path, schema), [key], ["batch_id", *order]).drop("batch_id")
