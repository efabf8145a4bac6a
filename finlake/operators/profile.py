"""Consolidated customer profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import AsOf, day_of_week, days_ago, moment, ratio, today
from .enrich import base_customer, classe_risco


def account_rollup(contas: DataFrame) -> DataFrame:
    kind = F.col("tipo_conta")
    return contas.groupBy("cliente_id").agg(
        F.count(F.lit(1)).alias("qtd_contas"),
        F.sum("saldo").alias("saldo_total"),
        F.avg("saldo").alias("saldo_medio"),
        F.sum("limite").alias("limite_total"),
        F.count_if(F.col("status") == "ATIVA").alias("contas_ativas"),
        F.count_if(kind == "CORRENTE").alias("tem_conta_corrente"),
        F.count_if(kind == "POUPANCA").alias("tem_poupanca"),
        F.count_if(kind == "INVESTIMENTO").alias("tem_investimento"),
    ).withColumn("utilizacao_limite_pct", ratio(F.col("saldo_total"), F.col("limite_total")) * 100)


# The counted columns.
KINDS = {"qtd_tipos_transacao": "tipo_transacao", "qtd_canais_utilizados": "canal"}


def _sums(as_of: AsOf) -> list[Column]:
    """Additive measures of the behaviour, so they can be rolled up again."""
    ts, valor, score = F.col("data_transacao"), F.col("valor"), F.col("score_risco")
    in30, in90 = ts >= days_ago(30, as_of), ts >= days_ago(90, as_of)
    return [
        F.count_if(in30).alias("n30"),
        F.sum(F.when(in30, valor).otherwise(0)).alias("v30"),
        F.count(F.when(in30, valor)).alias("c30"),
        F.count_if(in90).alias("n90"),
        F.sum(F.when(in90, valor).otherwise(0)).alias("v90"),
        F.count(F.when(in90, valor)).alias("c90"),
        F.sum(F.hour(ts)).alias("horas"),
        F.sum(day_of_week(ts)).alias("dias"),
        F.count(ts).alias("cts"),
        F.count_if(in30 & (F.col("tipo_transacao") == "PIX")).alias("pix30"),
        F.sum(score).alias("score"),
        F.count(score).alias("cscore"),
        F.max(score).alias("maxscore"),
        F.max(ts).alias("ultima"),
    ]


def _kinds(transacoes: DataFrame) -> DataFrame:
    """One narrow row per account and type or channel it used."""
    things = [F.struct(F.lit(i).alias("_i"), F.col(c).cast("string").alias("_kind")) for i, c in enumerate(KINDS.values())]
    return transacoes.select("conta_id", F.inline(F.array(*things))).distinct()


def _kind_counts(kinds: DataFrame, by: str) -> DataFrame:
    """Distinct types and channels, each counted once however many rows of ``_kinds`` name it."""
    own = kinds.select(by, "_i", "_kind").distinct() if by != "conta_id" else kinds
    counts = [F.count_if((F.col("_i") == i) & F.col("_kind").isNotNull()).alias(n) for i, n in enumerate(KINDS)]
    return own.groupBy(F.col(by).alias("_by")).agg(*counts)


def _behaviour(sums: DataFrame, kinds: DataFrame, by: str, as_of: AsOf) -> DataFrame:
    """Behaviour columns out of one row of ``_sums`` per ``by`` and the ``_kinds`` of these.

    The wide sums and the narrow kinds are aggregated apart: counted in one aggregate, each wide row would be held once for
    every counted column.
    """

    def mean(total: str, count: str) -> Column:
        return F.when(F.col(count) > 0, F.col(total) / F.col(count))

    # NULL is a ``by`` like any other.
    joined = sums.join(_kind_counts(kinds, by), F.col(by).eqNullSafe(F.col("_by")), "left")
    return joined.select(
        by,
        F.col("n30").alias("transacoes_30d"),
        F.col("v30").alias("volume_30d"),
        mean("v30", "c30").alias("ticket_medio_30d"),
        F.col("n90").alias("transacoes_90d"),
        F.col("v90").alias("volume_90d"),
        mean("v90", "c90").alias("ticket_medio_90d"),
        mean("horas", "cts").alias("hora_media_transacoes"),
        mean("dias", "cts").alias("dia_semana_medio"),
        F.col("pix30").alias("pix_30d"),
        mean("score", "cscore").alias("score_risco_medio_transacoes"),
        F.col("maxscore").alias("score_risco_max_transacoes"),
        *KINDS,
        F.col("ultima").alias("ultima_transacao"),
        (F.col("n90") / 13.0).alias("frequencia_semanal"),
        F.datediff(today(as_of), "ultima").alias("dias_desde_ultima_transacao"),
    )


def _distinct_30d(transacoes: DataFrame, as_of: AsOf) -> DataFrame:
    recent = transacoes.where(F.col("data_transacao") >= days_ago(30, as_of))
    return recent.groupBy("conta_id").agg(F.countDistinct("id").alias("qtd_transacoes_30d"))


def account_behaviour(transacoes: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Behaviour per account over 30 and 90 days."""
    sums = transacoes.groupBy("conta_id").agg(*_sums(as_of))
    whole = _behaviour(sums, _kinds(transacoes), "conta_id", as_of)
    return whole.join(_distinct_30d(transacoes, as_of), "conta_id", "left").fillna(0, ["qtd_transacoes_30d"])


def customer_behaviour(contas: DataFrame, transacoes: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Behaviour per customer over all of the customer's accounts.

    Transactions shrink to one row per account, type and channel before they meet the accounts.
    """
    owner = contas.select(F.col("id").alias("conta_id"), "cliente_id")
    by = ("conta_id", *KINDS.values())
    grain = transacoes.groupBy(*by).agg(*_sums(as_of))
    latest = ("maxscore", "ultima")
    sums = grain.join(owner, "conta_id").groupBy("cliente_id").agg(
        *[(F.max if c in latest else F.sum)(c).alias(c) for c in grain.columns if c not in by]
    )
    whole = _behaviour(sums, _kinds(transacoes).join(owner, "conta_id"), "cliente_id", as_of)
    ids = _distinct_30d(transacoes, as_of).join(owner, "conta_id").groupBy("cliente_id")
    ids = ids.agg(F.sum("qtd_transacoes_30d").alias("qtd_transacoes_30d"))
    return whole.join(ids, "cliente_id", "left").fillna(0, ["qtd_transacoes_30d"])


def customer_profile(
    clientes: DataFrame, contas: DataFrame, transacoes: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """One row per customer: identity, accounts, behaviour, risk class, activity flag."""
    base = base_customer(clientes, as_of).withColumnRenamed("id", "cliente_id")
    return (
        base.join(account_rollup(contas), "cliente_id", "left")
        .join(customer_behaviour(contas, transacoes, as_of), "cliente_id", "left")
        .withColumnRenamed("cliente_id", "id")
        .withColumns({
            "classe_risco": classe_risco(F.col("score_risco")),
            "perfil_ativo": F.coalesce(F.col("dias_desde_ultima_transacao") <= 30, F.lit(False)),
            "data_processamento": moment(as_of),
        })
    )
