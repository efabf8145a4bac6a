"""Aggregates of transactions, events and system measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import AsOf, ago, count_map, days_ago, moment, ratio, today
from ..functions.extras import NONE, Extras
from .ordered import running_totals


def _approved() -> Column:
    return F.count_if(F.col("aprovada"))


def _approval_rate() -> Column:
    return ratio(F.col("transacoes_aprovadas"), F.col("total_transacoes"))


def _common() -> list[Column]:
    return [F.count(F.lit(1)).alias("total_transacoes"), F.sum("valor").alias("valor_total")]


def metrics_hourly(df: DataFrame, extras: Extras = NONE) -> DataFrame:
    """Expects the columns added by ``enrich_transactions``."""
    return extras.checked(extras.rows(df).groupBy("hora", "tipo_transacao", "status").agg(
        *_common(),
        F.avg("valor").alias("valor_medio"),
        F.avg("score_risco").alias("score_risco_medio"),
        _approved().alias("transacoes_aprovadas"),
        F.sum("valor_alto").alias("transacoes_valor_alto"),
        *extras.columns(),
    ).withColumn("taxa_aprovacao", _approval_rate()))


def metrics_location(df: DataFrame, extras: Extras = NONE) -> DataFrame:
    return extras.checked(extras.rows(df).groupBy("estado", "cidade", "tipo_transacao").agg(
        *_common(),
        F.avg("score_risco").alias("score_risco_medio"),
        _approved().alias("transacoes_aprovadas"),
        *extras.columns(),
    ))


def metrics_account(df: DataFrame, extras: Extras = NONE) -> DataFrame:
    """Expects the columns added by ``enrich_transactions``."""
    return extras.checked(extras.rows(df).groupBy("conta_id").agg(
        *_common(),
        F.avg("valor").alias("valor_medio"),
        F.max("valor").alias("valor_maximo"),
        F.min("valor").alias("valor_minimo"),
        F.avg("score_risco").alias("score_risco_medio"),
        _approved().alias("transacoes_aprovadas"),
        F.sum("valor_alto").alias("transacoes_valor_alto"),
        *extras.columns(),
    ).withColumn("taxa_aprovacao", _approval_rate()))


def aggregate_daily(df: DataFrame, extras: Extras = NONE) -> DataFrame:
    """Per account and day.

    Ids are counted in a branch of their own that carries nothing else: next to the other measures
    Spark would shuffle all of them once per id.
    """

    def matches(column: str, value: str) -> Column:
        return F.count_if(F.col(column) == value).alias(f"qtd_{value.lower()}")

    df = extras.rows(df)
    day = F.date_trunc("day", "data_transacao")
    ids = df.select(F.col("conta_id").alias("_conta"), day.alias("_dia"), "id").distinct()
    ids = ids.groupBy("_conta", "_dia").agg(F.count("id").alias("qtd_transacoes_unicas"))
    sums = df.groupBy("conta_id", day.alias("data_ref")).agg(
        *_common(),
        F.avg("valor").alias("valor_medio"),
        F.max("valor").alias("valor_maximo"),
        F.min("valor").alias("valor_minimo"),
        F.stddev("valor").alias("valor_desvio_padrao"),
        *[matches("tipo_transacao", t) for t in ("PIX", "TED", "DOC", "DEBITO", "CREDITO")],
        *[matches("canal", c) for c in ("MOBILE", "WEB", "AGENCIA")],
        F.avg(F.hour("data_transacao")).alias("hora_media"),
        F.avg("score_risco").alias("score_risco_medio"),
        F.max("score_risco").alias("score_risco_maximo"),
        F.count_if(F.col("valor") > 1000).alias("qtd_valor_alto"),
        *extras.columns(),
    ).withColumn("ticket_medio", ratio(F.col("valor_total"), F.col("total_transacoes")))
    same = F.col("conta_id").eqNullSafe(F.col("_conta")) & F.col("data_ref").eqNullSafe(F.col("_dia"))
    return extras.checked(sums.join(ids, same).drop("_conta", "_dia"))


def aggregate_windows(
    df: DataFrame, days: Sequence[int] = (1, 7, 30), as_of: AsOf = None, extras: Extras = NONE
) -> DataFrame:
    """Daily account aggregates of the last N days, for each N.

    A window starts at midnight, so a day is inside it or not: the days are aggregated once for
    the longest window and the finished rows are repeated for the shorter ones.
    """
    recent = df.where(F.col("data_transacao") >= days_ago(max(days), as_of))
    windows = F.filter(
        F.array(*[F.lit(n) for n in sorted(days)]),
        lambda n: F.col("data_ref") >= F.date_sub(today(as_of), n).cast("timestamp"),
    )
    return aggregate_daily(recent, extras).withColumn("janela_dias", F.explode(windows)).withColumn("data_processamento", moment(as_of))


def aggregate_window(df: DataFrame, days: int, as_of: AsOf = None, extras: Extras = NONE) -> DataFrame:
    return aggregate_windows(df, (days,), as_of, extras)


def aggregate_global(df: DataFrame, extras: Extras = NONE) -> DataFrame:
    return extras.checked(extras.rows(df).groupBy(F.date_trunc("day", "data_transacao").alias("data_ref")).agg(
        *_common(),
        F.avg("valor").alias("valor_medio"),
        F.countDistinct("conta_id").alias("contas_ativas"),
        F.avg("score_risco").alias("score_risco_medio"),
        *extras.columns(),
    ))


def live_transaction_metrics(
    df: DataFrame, minutes: int = 60, as_of: AsOf = None, approved: str = "APROVADA"
) -> DataFrame:
    """One row over the last minutes.

    Score and latency are the plain mean of the group means. The group table is as small as the
    channel, type and state vocabularies, so the maps are built from a handful of rows.
    """
    groups = (
        df.where(F.col("data_transacao") >= ago(f"{minutes} minutes", as_of))
        .groupBy("canal", "tipo_transacao", "estado")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("valor").alias("valor"),
            F.avg("score_risco").alias("score"),
            F.count_if(F.col("status") == approved).alias("ok"),
            F.avg("tempo_processamento_ms").alias("ms"),
        )
    )
    sides = groups.groupingSets(
        [[], ["canal"], ["tipo_transacao"], ["estado"]], "canal", "tipo_transacao", "estado"
    ).agg(
        F.grouping_id().alias("g"),
        F.sum("n").alias("n"),
        F.sum("valor").alias("valor"),
        F.sum("ok").alias("ok"),
        F.avg("score").alias("score"),
        F.avg("ms").alias("ms"),
    )
    overall = F.col("g") == 7

    def only(name: str) -> Column:
        return F.max(F.when(overall, F.col(name)))

    def counts(name: str, grouping: int) -> Column:
        entry = F.when((F.col("g") == grouping) & F.col(name).isNotNull(), F.struct(F.col(name), F.col("n")))
        return F.map_from_entries(F.sort_array(F.collect_list(entry)))

    return sides.agg(
        only("n").alias("transacoes_por_minuto"),
        only("valor").alias("valor_total_por_minuto"),
        ratio(only("ok"), only("n")).alias("taxa_aprovacao"),
        only("score").alias("score_risco_medio"),
        only("ms").alias("tempo_resposta_medio"),
        counts("canal", 3).alias("transacoes_por_canal"),
        counts("tipo_transacao", 5).alias("transacoes_por_tipo"),
        counts("estado", 6).alias("transacoes_por_estado"),
    )


def live_risk_metrics(events: DataFrame, hours: int = 1, as_of: AsOf = None) -> DataFrame:
    level = F.col("nivel_risco")
    return events.where(F.col("data_evento") >= ago(f"{hours} hours", as_of)).agg(
        F.count(F.lit(1)).alias("total_alertas"),
        F.avg("score_risco").alias("score_risco_alertas"),
        F.count_if(level == "ALTO").alias("alertas_alto_risco"),
        F.count_if(level == "MEDIO").alias("alertas_medio_risco"),
        F.count_if(level == "BAIXO").alias("alertas_baixo_risco"),
    )


def live_system_metrics(df: DataFrame, minutes: int = 1, as_of: AsOf = None, ts: str = "timestamp") -> DataFrame:
    return df.where(F.col(ts) >= ago(f"{minutes} minutes", as_of)).agg(
        F.avg("tempo_resposta_ms").alias("tempo_resposta_medio"),
        F.count_if(F.col("status_code") >= 400).alias("erros_total"),
        F.count(F.lit(1)).alias("requests_total"),
    )


def minute_metrics(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Per minute: count, sum, mean to the cent, and the count of each type."""
    by_type = df.groupBy(F.date_trunc("minute", ts).alias("janela"), "tipo").agg(
        F.count(F.lit(1)).alias("n"), F.sum("valor").alias("valor")
    )
    return by_type.groupBy("janela").agg(
        F.sum("n").alias("total_transacoes"),
        F.sum("valor").alias("valor_total"),
        F.round(F.sum("valor") / F.sum("n"), 2).alias("valor_medio"),
        count_map("tipo", "n").alias("contagem_por_tipo"),
    )


def type_and_status() -> Column:
    return F.concat_ws("_", "tipo_transacao", "status")


def running_emissions(running: DataFrame, every: int) -> DataFrame:
    """Records of running totals (chave, n, total, hi, lo, seq) at every ``every``-th row of a key."""
    return running.where(F.col("n") % every == 0).select(
        F.lit("TRANSACTION_AGGREGATE").alias("metric_type"),
        F.col("chave").alias("key"),
        F.col("n").alias("count"),
        F.col("total").alias("total_value"),
        (F.col("total") / F.col("n")).alias("avg_value"),
        F.greatest(F.col("hi"), F.lit(0).cast(running.schema["hi"].dataType)).alias("max_value"),
        F.col("lo").alias("min_value"),
        F.col("seq").alias("last_id"),
    )


def running_metrics(
    df: DataFrame, every: int = 100, sequence: str = "id", start: DataFrame | None = None
) -> DataFrame:
    """Running figures per type and status, at every ``every``-th transaction of the key."""
    keyed = df.withColumn("chave", type_and_status())
    return running_emissions(running_totals(keyed, ["chave"], sequence, "valor", start=start), every)


def running_state(df: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """Totals per key after these rows: what the next micro-batch starts from."""
    keyed = df.select(
        type_and_status().alias("chave"),
        F.lit(1).cast("long").alias("n"),
        *[F.col("valor").alias(c) for c in ("total", "hi", "lo")],
    )
    known = keyed if start is None else keyed.unionByName(start)
    return known.groupBy("chave").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("hi").alias("hi"), F.min("lo").alias("lo")
    )
