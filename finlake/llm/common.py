"""Helpers the text operators share: shared scratch tables, byte access to Arrow text, training splits."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules["finlake"])

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_local_scratch: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; a temporary one on a single machine only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is not set; name a folder every executor can reach")
    if not _local_scratch:
        _local_scratch.append(tempfile.mkdtemp(prefix="finlake-"))
    return _local_scratch[0]


def settle(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: lineage ends here, lost executors repeat nothing.

    The folder is not removed, since the frame returned is read lazily; its owner clears ``<scratch>/finlake-llm``.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/finlake-llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


#: Files of a scan whose numbers are sent to all tasks; a table of more files is copied with its numbers.
MAX_FILES = 100_000


def numbered(rows: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of the rows (all by default) with a number each, the same in every scan.

    Rows read from Parquet are numbered by their file and their place in it, which no scan changes, however it splits the
    files. Other rows are written once with their numbers: made anew, these could differ, as splits follow the executors.
    """
    columns = columns or rows.columns
    file = unused("__file", [*rows.columns, name])
    try:
        placed = rows.withColumns({name: F.col("_metadata.row_index"), file: F.col("_metadata.file_path")})
        found = rows.select(F.col("_metadata.file_path").alias(file)).distinct().limit(MAX_FILES + 1).collect()
    except AnalysisException:
        found = None
    if found is None or len(found) > MAX_FILES:
        return settle(rows.select(*columns).withColumn(name, F.monotonically_increasing_id()), "numbered", "zstd")
    number = unused("__number", [*rows.columns, name])
    files = rows.sparkSession.createDataFrame([(f, i) for i, f in enumerate(sorted(r[0] for r in found))], f"{file} string, {number} long")
    place = F.shiftleft(number, 40) + F.col(name)
    return placed.join(F.broadcast(files), file).select(*columns, place.alias(name))


def unused(name: str, taken: list[str]) -> str:
    """The name, with further underscores while a column has it."""
    while name in taken:
        name += "_"
    return name


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; a null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def per_batch(df: DataFrame, build: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """Apply a function to every Arrow batch; ``build`` makes it once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = build()
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def fields_and(fields: list[T.StructField], more: str) -> T.StructType:
    """Schema of kept fields and further columns given as DDL."""
    return T.StructType([*fields, *T.StructType.fromDDL(more).fields])


def remainder(id_col: Column, of: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(id_col.cast("string")) % of


def is_remainder(id_col: Column, of: int, value: int) -> Column:
    return F.coalesce(remainder(id_col, of) == value, F.lit(False))


def not_remainder(id_col: Column, of: int, value: int) -> Column:
    """Rows to learn from; a row without an id is neither held out nor learned from."""
    return F.coalesce(remainder(id_col, of) != value, F.lit(False))
