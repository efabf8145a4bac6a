"""Running operators as streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import latest_by_key
from ..session import checkpoint_path
from ..sinks import as_messages, write_batch, write_jdbc

BatchWriter = Callable[[DataFrame, int], None]


def run_stream(
    result: DataFrame,
    write: BatchWriter,
    name: str,
    *,
    mode: str = "append",
    trigger: str | None = "30 seconds",
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``write(batch, batch_id)``.

    ``trigger=None`` processes what is there and stops. Each query has its own checkpoint below
    the session's checkpoint folder. A batch may be handed over again after a failure, so
    ``write`` must replace what it wrote under the same ``batch_id``.
    """
    location = checkpoint or checkpoint_path(result.sparkSession, name)
    writer = result.writeStream.queryName(name).outputMode(mode).foreachBatch(write)
    writer = writer.option("checkpointLocation", location)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def parquet_batches(path: str, *partition_by: str) -> BatchWriter:
    """Keyed tables read these with ``sinks.read_current``: the newest batch wins per key."""
    return lambda batch, batch_id: write_batch(batch, path, batch_id, partition_by)


def replace_batch(table: str, staging: str, batch_id: int) -> list[str]:
    """Statements that put a staged batch in the place of what the table holds of it; run them as one transaction."""
    return [f"DELETE FROM {table} WHERE batch_id = {batch_id}", f"INSERT INTO {table} SELECT * FROM {staging}"]


def jdbc_batches(
    url: str, table: str, transaction: Callable[[Sequence[str]], None], staging: str | None = None, **options: str
) -> BatchWriter:
    """A table that holds every batch once, stamped with its id.

    Tasks write to a staging table that each batch overwrites, so a batch that fails midway leaves the table as it was;
    ``transaction`` then runs the statements that replace the batch, all or none.
    """
    staged = staging or f"{table}_lote"

    def write(batch: DataFrame, batch_id: int) -> None:
        write_jdbc(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), url, staged, mode="overwrite", **options)
        transaction(replace_batch(table, staged, batch_id))

    return write


def documents(batch: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per document id, the last by ``order``; rows without an id get one from their content."""
    content = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in batch.columns])), 256)
    keyed = batch.withColumn(key, F.coalesce(F.col(key).cast("string"), content))
    return latest_by_key(keyed, [key], order)


def connector_batches(
    fmt: str, key: str, order: Sequence[str] = (), key_option: str = "es.mapping.id", **options: str
) -> BatchWriter:
    """Any batch connector that replaces the document of an id, such as a search index.

    ``key_option`` is the connector's setting that names the id column. Every document of a batch has an id that follows
    from the row, so a batch handed over again, whole or from the middle, replaces its own documents.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        writer = documents(batch, key, order).write.format(fmt).options(**{key_option: key}, **options)
        writer.mode("append").save()

    return write


def topic_stream(
    alerts: DataFrame, name: str, fmt: str = "kafka", key: str | None = None, checkpoint: str | None = None,
    trigger: str | None = "30 seconds", **options: str,
) -> StreamingQuery:
    """Rows as JSON messages to a topic (or to text files of JSON lines)."""
    location = checkpoint or checkpoint_path(alerts.sparkSession, name)
    messages = as_messages(alerts, key)
    writer = messages.writeStream.queryName(name).format(fmt).options(**options)
    writer = writer.option("checkpointLocation", location)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()
