"""Newest row per key, keyed upsert, history limits.

Everything here combines on the map side before rows move, so a key that holds a large share of
the rows reaches its reducer as one candidate (or ``n`` candidates) per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _tie_free(df: DataFrame, order: Sequence[str | Column]) -> Column:
    """Ordering that is total over distinct rows, so re-runs pick the same winner."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    return F.struct(*columns, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if not _is_map(df, c)]))


def _is_map(df: DataFrame, name: str) -> bool:
    return "map<" in df.schema[name].dataType.simpleString()


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` per key (NULLs sort lowest)."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), _tie_free(df, order)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*df.columns)


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()
) -> DataFrame:
    """Insert new keys, replace the other columns of known keys.

    ``target`` holds one row per key. Only updates are reduced and only their keys are matched
    against the target, so a small batch is broadcast (by its measured size) and the target is not
    shuffled. ``order`` picks the winner among several updates of a key.
    """
    incoming = latest_by_key(updates, keys, order).select(*target.columns)
    kept = target.join(incoming.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(incoming)


def keep_latest(df: DataFrame, series: Sequence[str], ts: str, n: int = 100) -> DataFrame:
    """The newest ``n`` points of each series; Spark cuts to ``n`` before the shuffle, equal times have a fixed order."""
    newest_first = Window.partitionBy(*series).orderBy(_tie_free(df, [ts]).desc())
    return df.withColumn("_rn", F.row_number().over(newest_first)).where(F.col("_rn") <= n).drop("_rn")
