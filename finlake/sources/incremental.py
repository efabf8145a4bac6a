"""Watermark-driven extraction."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import moment


def incremental_extract(df: DataFrame, watermark: str | datetime | None, ts: str = "data_atualizacao") -> DataFrame:
    """Rows changed strictly after the watermark; the whole table when there is none."""
    if watermark is None:
        return df
    return df.where(F.col(ts) > moment(watermark))


def next_watermark(df: DataFrame, ts: str = "data_atualizacao") -> DataFrame:
    """One row with the newest change time, or no row when nothing was extracted."""
    if ts not in df.columns:
        return df.sparkSession.createDataFrame([], "watermark timestamp")
    return df.agg(F.max(ts).alias("watermark")).where(F.col("watermark").isNotNull())


def read_watermark(spark: SparkSession, path: str) -> datetime | None:
    """Newest stored watermark, or None before the first run."""
    try:
        stored = spark.read.schema("watermark timestamp").parquet(path)
        return stored.agg(F.max("watermark")).head()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_watermark(watermark: DataFrame, path: str) -> None:
    """Add the new watermark; nothing is written when the extract was empty.

    Appending keeps the earlier value until the new file is committed.
    """
    watermark.coalesce(1).write.mode("append").parquet(path)
