"""Monthly reports to the regulator."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_month(ts: str, year: int, month: int) -> Column:
    """Half-open range on the column itself, so a scan can skip files and row groups."""
    first = date(year, month, 1)
    following = date(year + month // 12, month % 12 + 1, 1)
    start, end = (F.lit(str(d)).cast("timestamp") for d in (first, following))
    return (F.col(ts) >= start) & (F.col(ts) < end)


def _period(year: int, month: int) -> Column:
    return F.lit(f"{year}-{month:02d}").alias("periodo")


def monthly_statistics(
    df: DataFrame, year: int, month: int, approved: str = "APROVADA", rejected: str = "REJEITADA"
) -> DataFrame:
    status = F.col("status")
    return (
        df.where(in_month("data_transacao", year, month))
        .groupBy("tipo_transacao")
        .agg(
            F.count(F.lit(1)).alias("total_transacoes"),
            F.sum("valor").alias("valor_total"),
            F.avg("valor").alias("valor_medio"),
            F.count_if(status == approved).alias("transacoes_aprovadas"),
            F.count_if(status == rejected).alias("transacoes_rejeitadas"),
        )
        .select(_period(year, month), "*")
    )


def monthly_risk_report(events: DataFrame, year: int, month: int) -> DataFrame:
    return (
        events.where(in_month("data_evento", year, month))
        .groupBy("tipo_evento", "nivel_risco")
        .agg(
            F.count(F.lit(1)).alias("total_eventos"),
            F.avg("score_risco").alias("score_risco_medio"),
            F.count_if(F.col("resolvido").cast("int") == 1).alias("eventos_resolvidos"),
        )
        .select(_period(year, month), "*")
    )
