"""Keyed tables laid out for their key: bucketed by it, sorted within the bucket, merged bucket by bucket.

The layout is part of the catalogue entry, so joins and aggregates on the key need no shuffle of the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.latest import latest_by_key

BUCKETS = 64


def write_keyed(
    df: DataFrame, name: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int = BUCKETS, path: str | None = None
) -> None:
    """Create the table ``name`` from the rows: one sorted file per bucket.

    ``path`` puts the files below a folder of their own in a shared store; otherwise they go to the warehouse.
    """
    by = list(dict.fromkeys([*keys, *order]))
    writer = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*by)
    if path:
        writer = writer.option("path", f"{path.rstrip('/')}/{uuid.uuid4().hex}")
    writer.mode("errorifexists").saveAsTable(name)


def layout(spark: SparkSession, name: str) -> tuple[list[str], list[str], int]:
    """(bucket columns, sort columns, buckets) of a table as the catalogue has them."""
    rows = {r["col_name"].strip().lower(): r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}

    def names(text: str | None) -> list[str]:
        return [c.strip().strip("`") for c in (text or "").strip("[]").split(",") if c.strip()]

    return names(rows.get("bucket columns")), names(rows.get("sort columns")), int(rows.get("num buckets") or 0)


def merge_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``latest.upsert`` as one outer join: known keys take the update's columns, new keys are added.

    ``target`` holds one row per key; ``order`` picks the winner among several updates of a key. Where the target is
    bucketed by the keys only the updates move, and the result stays in the target's buckets. Rows of either side with a
    NULL key are kept as they are, updates reduced to one by ``order``.
    """
    incoming = latest_by_key(updates, keys, order).select(*target.columns)
    rest = [c for c in target.columns if c not in keys]
    both = target.alias("t").join(
        incoming.select(*keys, F.struct(F.lit(True).alias("_met"), *rest).alias("_new")).alias("u"), list(keys), "full_outer"
    )
    met = F.col("_new").isNotNull()
    return both.select(*keys, *[F.when(met, F.col(f"_new.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in rest]).select(*target.columns)


def merge_into(spark: SparkSession, name: str, updates: DataFrame, order: Sequence[str] = (), path: str | None = None) -> None:
    """Merge updates into a keyed table, which keeps its layout.

    The merged rows are written beside the table and take its name when they are complete. A run that was broken off
    leaves the old table or, between the two renames, its copy, which the next run puts back first.
    """
    before, after = f"{name}_anterior", f"{name}_novo"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(before):
        spark.sql(f"ALTER TABLE {before} RENAME TO {name}")
    for left in (before, after):
        spark.sql(f"DROP TABLE IF EXISTS {left}")
    keys, order_columns, buckets = layout(spark, name)
    merged = merge_rows(spark.table(name), updates, keys, order)
    writer = merged.write.format("parquet").bucketBy(buckets, *keys).sortBy(*order_columns)
    if path:
        writer = writer.option("path", f"{path.rstrip('/')}/{uuid.uuid4().hex}")
    writer.saveAsTable(after)
    spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
    spark.sql(f"ALTER TABLE {after} RENAME TO {name}")
    spark.sql(f"DROP TABLE {before}")


def create_keyed(
    spark: SparkSession, name: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str] = (), buckets: int = BUCKETS,
    path: str | None = None,
) -> None:
    """An empty keyed table, unless there is one."""
    if not spark.catalog.tableExists(name):
        write_keyed(spark.createDataFrame([], schema), name, keys, order, buckets, path)
