"""Batch and streaming readers. Connector formats are parameters; no client code lives here."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TRANSACAO


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    num_partitions: int = 64,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """Table scan; filters put on the result are pushed to the database by Spark.

    With ``partition_column`` (and its bounds) the scan is split over many connections.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("fetchsize", fetch_size).options(**options)
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("partition_column needs lower and upper bounds")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", num_partitions)
        )
    return reader.load()


def read_json(spark: SparkSession, path: str, schema: T.StructType = TRANSACAO) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_feature_source(spark: SparkSession, path: str, event_timestamp: str = "event_timestamp") -> DataFrame:
    """Offline source of a feature view; fails early when the time column is missing."""
    df = spark.read.parquet(path)
    if event_timestamp not in df.columns:
        raise ValueError(f"{path} has no column {event_timestamp}")
    return df


def parse_events(raw: DataFrame, schema: T.StructType | str = TRANSACAO, value: str = "value") -> DataFrame:
    """Typed columns out of a JSON message column."""
    return raw.select(F.from_json(F.col(value).cast("string"), schema).alias("data")).select("data.*")


def read_event_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    schema: T.StructType = TRANSACAO,
    watermark: str | None = None,
    event_time: str = "data_transacao",
    **options: str,
) -> DataFrame:
    """Stream of transactions.

    ``kafka`` (and any format with a ``value`` column) carries JSON messages and starts at the
    latest offsets unless told otherwise; file formats carry the columns themselves.
    """
    reader = spark.readStream.format(fmt)
    path = options.pop("path", None)
    if fmt == "kafka":
        options.setdefault("startingOffsets", "latest")
    elif fmt in ("json", "parquet", "orc", "csv"):
        reader = reader.schema(schema)
    stream = reader.options(**options).load(path) if path else reader.options(**options).load()
    if "value" in stream.columns and "conta_id" not in stream.columns:
        stream = parse_events(stream, schema)
    return stream.withWatermark(event_time, watermark) if watermark else stream


class SourceRegistry:
    """Named sources (contas, clientes, transacoes, ...) and the reader of each."""

    def __init__(self, readers: Mapping[str, Callable[[SparkSession], DataFrame]] | None = None):
        self._readers = dict(readers or {})

    def declare(self, name: str, reader: Callable[[SparkSession], DataFrame]) -> None:
        self._readers[name] = reader

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        if name not in self._readers:
            raise KeyError(f"source {name} is not declared")
        return self._readers[name](spark)

    def register_views(self, spark: SparkSession) -> list[str]:
        for name, reader in self._readers.items():
            reader(spark).createOrReplaceTempView(name)
        return sorted(self._readers)
