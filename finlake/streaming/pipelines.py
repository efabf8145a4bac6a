"""Streaming pipelines built from the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import alerts, metrics, windows
from ..operators.enrich import enrich_transactions
from .runner import BatchWriter, run_stream

# How late an event may be, per pipeline.
WATERMARKS = {"fraude": "5 seconds", "pix": "3 seconds", "analytics": "1 second"}


def transaction_pipeline(
    stream: DataFrame, writers: Mapping[str, BatchWriter], trigger: str | None = "30 seconds", **checkpoints: str
) -> list[StreamingQuery]:
    """Enriched rows (append) and the three running aggregates (update), one query each."""
    rows = enrich_transactions(stream)
    parts = {
        "transacoes": (rows, "append"),
        "metricas_horarias": (metrics.metrics_hourly(rows), "update"),
        "metricas_localizacao": (metrics.metrics_location(rows), "update"),
        "metricas_conta": (metrics.metrics_account(rows), "update"),
    }
    return [
        run_stream(df, writers[name], name, mode=mode, trigger=trigger, checkpoint=checkpoints.get(name))
        for name, (df, mode) in parts.items()
        if name in writers
    ]


FRAUD_RULES = {
    "alto_valor_noturno": alerts.high_value_at_night,
    "transacoes_rapidas": alerts.rapid_transactions,
    "acumulo_valor": alerts.value_build_up,
}
PIX_RULES = {
    "pix_alto_valor": alerts.pix_high_value,
    "pix_varredura": alerts.pix_sweep,
    "pix_horario_anomalo": alerts.pix_odd_hours,
    "pix_multi_cidade": alerts.pix_many_cities,
}
ANALYTICS = {
    "metricas_por_segundo": windows.metrics_per_second,
    "volume_deslizante": windows.sliding_volume,
    "canal_deslizante": windows.sliding_channel,
    "aprovacao_deslizante": windows.sliding_approval,
    "metricas_por_hora": windows.metrics_per_hour,
}


def rule_pipeline(
    stream: DataFrame, rules: Mapping, writers: Mapping[str, BatchWriter], trigger: str | None = "30 seconds",
    **checkpoints: str,
) -> list[StreamingQuery]:
    """One query per rule; ``stream`` carries the watermark."""
    return [
        run_stream(rule(stream), writers[name], name, trigger=trigger, checkpoint=checkpoints.get(name))
        for name, rule in rules.items()
        if name in writers
    ]


def first_flagged_stream(risk_alerts: DataFrame) -> DataFrame:
    """Each account once, when its first high-risk alert arrives; ``state.flagged_account_stream`` forgets in time."""
    return alerts.flagged_accounts(risk_alerts)
