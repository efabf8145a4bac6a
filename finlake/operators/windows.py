"""Event-time windows for batch and streaming input alike."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tumbling(df: DataFrame, size: str, keys: Sequence[str], measures: Mapping[str, Column], ts: str) -> DataFrame:
    aggregated = df.groupBy(F.window(ts, size), *keys).agg(*[m.alias(n) for n, m in measures.items()])
    return aggregated.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *measures
    )


def hopping(
    df: DataFrame, size: str, slide: str, keys: Sequence[str], sums: Mapping[str, Column], ts: str
) -> DataFrame:
    """Sums over sliding windows; ``slide`` must divide ``size``.

    Rows are summed once per slide-long pane and only the panes are repeated for the windows they belong to, instead of
    repeating every row. On a stream these are two chained aggregations: a pane enters its windows when the watermark
    has passed it.
    """
    if df.isStreaming:
        return _bounds(_hops(df, size, slide, keys, sums, ts), keys, sums)
    panes = df.groupBy(F.window(ts, slide).alias("pane"), *keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    last = F.col("pane.start")
    first = F.col("pane.end") - F.expr(f"INTERVAL {size}")
    starts = F.explode(F.sequence(first, last, F.expr(f"INTERVAL {slide}"))).alias("window_start")
    spread = panes.select(starts, *keys, *sums)
    return (
        spread.groupBy("window_start", *keys)
        .agg(*[F.sum(n).alias(n) for n in sums])
        .withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {size}"))
        .select("window_start", "window_end", *keys, *sums)
    )


def _hops(
    df: DataFrame, size: str, slide: str, keys: Sequence[str], sums: Mapping[str, Column], ts: str
) -> DataFrame:
    """(window, keys, sums) of a stream; ``window`` carries the watermark on."""
    panes = df.groupBy(F.window(ts, slide).alias("pane"), *keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    # The last microsecond of a pane lies in the windows that hold the pane.
    timed = panes.select(F.window_time("pane").alias("pane_time"), *keys, *sums)
    return timed.groupBy(F.window("pane_time", size, slide).alias("window"), *keys).agg(*[F.sum(n).alias(n) for n in sums])


def _bounds(aggregated: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    return aggregated.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *names
    )


def distinct_in_hops(
    df: DataFrame, size: str, slide: str, key: str, distinct: str, sums: Mapping[str, Column], ts: str
) -> DataFrame:
    """Per sliding window and key: number of distinct values and sums over all rows.

    Two grouping steps instead of a set per group, so nothing grows with the number of values; on
    a stream they are a further chained aggregation.
    """
    counts = [F.count(distinct).alias("distintos"), *[F.sum(n).alias(n) for n in sums]]
    if df.isStreaming:
        by_value = _hops(df, size, slide, [key, distinct], sums, ts)
        return _bounds(by_value.groupBy("window", key).agg(*counts), [key], ["distintos", *sums])
    by_value = hopping(df, size, slide, [key, distinct], sums, ts)
    return by_value.groupBy("window_start", "window_end", key).agg(*counts)


def _approved() -> Column:
    return F.sum(F.when(F.col("aprovada"), 1).otherwise(0)) / F.count(F.lit(1))


def metrics_per_second(df: DataFrame, ts: str = "data_transacao") -> DataFrame:
    return tumbling(df, "1 second", ["tipo_transacao", "canal", "status"], {
        "total_transacoes": F.count(F.lit(1)),
        "valor_total": F.sum("valor"),
        "valor_medio": F.avg("valor"),
        "score_risco_medio": F.avg("score_risco"),
        "taxa_aprovacao": _approved(),
        "tempo_resposta_medio": F.avg(F.col("tempo_processamento_ms").cast("double")),
    }, ts)


def metrics_per_hour(df: DataFrame, ts: str = "data_transacao") -> DataFrame:
    return tumbling(df, "1 hour", ["tipo_transacao", "status"], {
        "total_transacoes": F.count(F.lit(1)),
        "valor_total": F.sum("valor"),
        "valor_medio": F.avg("valor"),
        "score_risco_medio": F.avg("score_risco"),
    }, ts)


def _metric(df: DataFrame, name: str, value: Column, dimension: str, member: Column) -> DataFrame:
    return df.select(
        "window_start", "window_end",
        F.lit(name).alias("metrica_tipo"),
        value.cast("double").alias("valor"),
        F.lit(dimension).alias("dimensao"),
        member.alias("dimensao_valor"),
    )


def sliding_volume(
    df: DataFrame, size: str = "5 minutes", slide: str = "10 seconds", ts: str = "data_transacao"
) -> DataFrame:
    sums = hopping(df, size, slide, ["tipo_transacao"], {"total": F.col("valor")}, ts)
    return _metric(sums, "VOLUME_TRANSACOES", F.col("total"), "tipo_transacao", F.col("tipo_transacao"))


def sliding_channel(
    df: DataFrame, size: str = "5 minutes", slide: str = "10 seconds", ts: str = "data_transacao"
) -> DataFrame:
    sums = hopping(df, size, slide, ["canal"], {"total": F.lit(1)}, ts)
    return _metric(sums, "TRANSACOES_POR_CANAL", F.col("total"), "canal", F.col("canal"))


def sliding_approval(
    df: DataFrame, size: str = "5 minutes", slide: str = "10 seconds", ts: str = "data_transacao"
) -> DataFrame:
    approved = F.when(F.col("aprovada"), 1).otherwise(0)
    sums = hopping(df, size, slide, [], {"ok": approved, "total": F.lit(1)}, ts)
    return _metric(sums, "TAXA_APROVACAO", F.col("ok") / F.col("total"), "global", F.lit("GLOBAL"))
