"""Writers and table maintenance."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.columns import AsOf, ago, moment
from .operators.enrich import normalize_types
from .operators.latest import latest_by_key
from .schemas import target_type
from .tables import BUCKETS, create_keyed

# Retention per table, in days.
RETENTION_DAYS = {"cliente_pf": 2555, "cliente_pj": 2555, "auditoria": 1825, "transacao": 1825}


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", batch_size: int = 1000, **options) -> None:
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    writer.options(**options).mode(mode).save()


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Idempotent micro-batch write: a repeated batch replaces its own folder."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")


def write_bronze(df: DataFrame, root: str, source: str, table: str, batch_id: int, as_of: AsOf = None) -> None:
    """``<root>/<source>/<table>/batch_id=N/ingest_date=D``; earlier loads of the day stay."""
    dated = df.withColumn("ingest_date", F.to_date(moment(as_of)))
    write_batch(dated, f"{root}/{source}/{table}", batch_id, ("ingest_date",))


def read_current(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Newest row per key over all batches below ``path``: the read side of a keyed upsert sink.

    Batches only append, so the cost of a write follows the size of the batch, not of the table.
    """
    rows = spark.read.parquet(path)
    return latest_by_key(rows, keys, ["batch_id", *order]).drop("batch_id")


def compact(spark: SparkSession, path: str, keys: Sequence[str], out: str, order: Sequence[str] = ()) -> None:
    """Write the current rows as batch 0 of a new folder; readers switch to it when it is complete."""
    write_batch(read_current(spark, path, keys, order), out, 0)


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON messages for a topic."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def analytics_table(df: DataFrame, source_types: Mapping[str, str] | None = None, as_of: AsOf = None) -> DataFrame:
    """Rows in the column types of the analytics copy, with its ``created_at``."""
    types = source_types or {}
    columns = [F.col(c).try_cast(target_type(types[c])).alias(c) if c in types else F.col(c) for c in df.columns]
    return df.select(*columns).withColumn("created_at", moment(as_of))


def create_target_table(
    spark: SparkSession, name: str, source_types: Mapping[str, str], path: str | None = None, keys: Sequence[str] = ("id",),
    buckets: int = BUCKETS,
) -> T.StructType:
    """Create the empty analytics table of a source table (if absent) and return its schema.

    The table is bucketed by its keys and sorted by keys and ``created_at``; ``tables.merge_into`` keeps it so.
    """
    fields = [T.StructField(c, target_type(t)) for c, t in source_types.items()]
    schema = T.StructType([*fields, T.StructField("created_at", T.TimestampType())])
    create_keyed(spark, name, schema, keys, ("created_at",), buckets, path)
    return schema


def changed_since(df: DataFrame, since: AsOf = None, as_of: AsOf = None, ts: str = "data_atualizacao") -> DataFrame:
    """Rows to sync: changed strictly after ``since`` (default one hour back), types normalised."""
    start = ago("1 hour", as_of) if since is None else moment(since)
    return normalize_types(df.where(F.col(ts) > start))


def sync_table(
    df: DataFrame, write: Callable[[DataFrame], None], since: AsOf = None, as_of: AsOf = None, ts: str = "data_atualizacao"
) -> None:
    """Append the changed rows, each task in change order."""
    write(changed_since(df, since, as_of, ts).sortWithinPartitions(ts))


def sync_all(tables: Mapping[str, Callable[[], None]]) -> list[dict]:
    """Run each table's sync; one table's failure does not stop the others."""
    status = []
    for name, run in tables.items():
        try:
            run()
            status.append({"tabela": name, "ok": True, "erro": None})
        except Exception as error:  # noqa: BLE001 - reported per table
            status.append({"tabela": name, "ok": False, "erro": str(error)})
    return status


def is_expired(days: int, as_of: AsOf = None, ts: str = "data_atualizacao") -> Column:
    """Older than the retention; an unknown time is never expired."""
    return F.coalesce(F.col(ts) < ago(f"{days} days", as_of), F.lit(False))


def purge_expired(df: DataFrame, days: int, as_of: AsOf = None, ts: str = "data_atualizacao") -> DataFrame:
    """Rows that stay."""
    return df.where(~is_expired(days, as_of, ts))


def purge_counts(
    tables: Mapping[str, DataFrame | None],
    as_of: AsOf = None,
    ts: str = "data_atualizacao",
    retention: Mapping[str, int] = RETENTION_DAYS,
) -> DataFrame:
    """Removed rows per table; 0 for a table that does not exist."""
    out = None
    for name, days in retention.items():
        df = tables.get(name)
        if df is None:
            spark = next(t for t in tables.values() if t is not None).sparkSession
            row = spark.range(1).select(F.lit(name).alias("tabela"), F.lit(0).cast("long").alias("removidos"))
        else:
            row = df.agg(F.count_if(is_expired(days, as_of, ts)).alias("removidos"))
            row = row.select(F.lit(name).alias("tabela"), "removidos")
        out = row if out is None else out.unionByName(row)
    return out


def save_report(report: DataFrame, path: str, as_of: AsOf = None) -> None:
    """Add the run to the history and replace the latest copy; ``timestamp`` is UTC with a Z.

    A repeated run replaces its own folder of the history.
    """
    stamp = F.date_format(moment(as_of), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    stamped = report.withColumn("timestamp", stamp)
    run = stamped.withColumn("run_ts", F.date_format(moment(as_of), "yyyyMMdd_HHmmss"))
    run = run.persist()
    history = run.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    history.partitionBy("run_ts").json(f"{path}/history")
    run.drop("run_ts").write.mode("overwrite").json(f"{path}/latest")
    run.unpersist()


def score_write_back(scores: DataFrame) -> DataFrame:
    """Staging rows that carry the new score back to the customers."""
    return scores.select(F.col("id").alias("cliente_id"), "score_risco_calculado")


def write_dead_letters(batch: DataFrame, bad: Column, path: str, batch_id: int) -> None:
    """Both halves of one micro-batch in one pass, below the batch's folder: ``rejeitado=0`` and ``rejeitado=1``.

    A row for which the condition is unknown is rejected, so none is lost. A repeated batch replaces its folder.
    """
    marked = batch.withColumn("rejeitado", F.coalesce(bad, F.lit(True)).cast("int"))
    write_batch(marked, path, batch_id, ("rejeitado",))


def read_half(spark: SparkSession, path: str, rejected: bool = False) -> DataFrame:
    """Valid rows, or the rejected ones, of all batches ``write_dead_letters`` left."""
    return spark.read.parquet(path).where(F.col("rejeitado") == int(rejected)).drop("rejeitado")
