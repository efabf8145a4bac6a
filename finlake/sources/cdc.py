"""Change-data messages: parsing, draining a topic, materialising the current table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.latest import latest_by_key
from ..schemas import cdc_envelope
from ..sinks import write_batch

def iso_utc(ts: Column) -> Column:
    """ISO text with offset; the fraction appears only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    fraction = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(fraction)


def parse_cdc(messages: DataFrame, row: str, value: str = "value") -> DataFrame:
    """Row images with ``_cdc_op``, ``_cdc_ts`` (ISO, UTC) and ``_cdc_deleted``.

    ``row`` is the DDL of the row image. A delete takes its image from ``before``. Messages that
    are null, empty, not JSON, or carry no image are dropped. Other columns of ``messages``
    (topic, offset, ...) are kept.
    """
    keep = [c for c in messages.columns if c != value]
    parsed = messages.select(*keep, F.from_json(F.col(value).cast("string"), cdc_envelope(row)).alias("m"))
    image = F.coalesce(F.col("m.after"), F.when(F.col("m.op") == "d", F.col("m.before")))
    ts_ms = F.coalesce(F.nullif(F.col("m.ts_ms"), F.lit(0)), F.nullif(F.col("m.source.ts_ms"), F.lit(0)))
    return (
        parsed.withColumn("image", image)
        .where(F.col("image").isNotNull())
        .select(
            *keep,
            "image.*",
            F.coalesce(F.nullif(F.col("m.op"), F.lit("")), F.lit("u")).alias("_cdc_op"),
            iso_utc(F.timestamp_millis(ts_ms)).alias("_cdc_ts"),
            F.coalesce(F.col("m.op") == "d", F.lit(False)).alias("_cdc_deleted"),
        )
    )


def apply_cdc(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ("_cdc_ts",)) -> DataFrame:
    """Current state of the table: the newest change per key, deleted keys left out.

    Add the log position to ``order`` where several changes of a key may share a time.
    """
    newest = latest_by_key(changes, keys, order)
    return newest.where(~F.col("_cdc_deleted")).drop("_cdc_op", "_cdc_ts", "_cdc_deleted")


def parse_topics(messages: DataFrame, rows: Mapping[str, str]) -> dict[str, DataFrame]:
    """Parsed changes of each topic, with the columns its own row DDL names."""
    present = messages.where(F.col("value").isNotNull())
    return {topic: parse_cdc(present.where(F.col("topic") == topic), ddl) for topic, ddl in rows.items()}


def drain_topics(stream: DataFrame, rows: Mapping[str, str], path: str, checkpoint: str) -> None:
    """Consume what is there, write it below ``path`` by table and day, then stop.

    ``rows`` has the row DDL of every topic to read; each table's folder holds its own columns. The
    source bounds a batch itself (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``). Offsets are
    committed after the write, and a repeated batch replaces its own files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        for topic, changes in parse_topics(batch, rows).items():
            dated = changes.withColumn("ingest_date", F.current_date())
            write_batch(dated, f"{path}/{topic.rpartition('.')[2]}", batch_id, ("ingest_date",))
        batch.unpersist()

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
