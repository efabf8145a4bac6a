"""Composite risk score of a customer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bitmaps import distinct_counts
from ..functions.columns import AsOf, is_night, moment, ratio, today
from .enrich import neutral_fill, nivel_risco

# Weight of each component.
WEIGHTS = {
    "score_comportamento": 0.35,
    "score_credito": 0.25,
    "score_atividade": 0.20,
    "score_concentracao": 0.10,
    "score_diversidade": 0.10,
}


def _active_days() -> dict[str, Column]:
    return {"dias_ativos": F.to_date("data_transacao")}


def _behaviour_counts() -> dict[str, Column]:
    return {
        "total": F.lit(True),
        "noturnas": is_night(F.col("data_transacao")),
        "alto_valor": F.col("valor") > 10000,
    }


def account_activity(transacoes: DataFrame) -> DataFrame:
    """Everything the account scores need; days, kinds, channels and cities of an account are counted as bitmaps."""
    return distinct_counts(
        transacoes, "conta_id", _active_days(), {"tipos": "tipo_transacao", "canais": "canal", "cidades": "cidade"},
        _behaviour_counts(),
    )


# The cuts, factors and points of the scores below.
def _behaviour() -> Column:
    regular = F.least(F.col("dias_ativos") / 90.0, F.lit(1.0))
    night, high = ratio(F.col("noturnas"), F.col("total")), ratio(F.col("alto_valor"), F.col("total"))
    return (regular * 60 + (1 - night) * 20 + (1 - high) * 20).cast("int")


def _activity() -> Column:
    daily = F.col("dias_ativos") / 90.0
    return F.least((daily * 50 + F.col("tipos") * 10 + F.col("canais") * 10).cast("int"), F.lit(100))


def _concentration() -> Column:
    cities = F.col("cidades")
    return F.when(cities <= 2, 90).when(cities <= 5, 70).when(cities <= 10, 50).otherwise(30)


def account_scores(transacoes: DataFrame) -> DataFrame:
    return account_activity(transacoes).select(
        "conta_id",
        _behaviour().alias("score_comportamento"),
        _activity().alias("score_atividade"),
        _concentration().alias("score_concentracao"),
    )


def score_behaviour(transacoes: DataFrame) -> DataFrame:
    activity = distinct_counts(transacoes, "conta_id", _active_days(), counts=_behaviour_counts())
    return activity.select("conta_id", _behaviour().alias("score_comportamento"))


def score_activity(transacoes: DataFrame) -> DataFrame:
    activity = distinct_counts(transacoes, "conta_id", _active_days(), {"tipos": "tipo_transacao", "canais": "canal"})
    return activity.select("conta_id", _activity().alias("score_atividade"))


def score_concentration(transacoes: DataFrame) -> DataFrame:
    cities = distinct_counts(transacoes, "conta_id", values={"cidades": "cidade"})
    return cities.select("conta_id", _concentration().alias("score_concentracao"))


def _credit() -> Column:
    used = ratio(F.col("saldo_total"), F.col("limite_total"))
    return F.when(used < 0.3, 90).when(used < 0.5, 75).when(used < 0.8, 50).otherwise(25)


def _diversity() -> Column:
    return F.least(F.col("tipos_conta") * 25, F.lit(100)).cast("int")


def product_scores(contas: DataFrame) -> DataFrame:
    """Credit use and product diversity in one pass over the accounts."""
    return contas.groupBy("cliente_id").agg(
        F.sum("limite").alias("limite_total"),
        F.sum("saldo").alias("saldo_total"),
        F.countDistinct("tipo_conta").alias("tipos_conta"),
    ).select("cliente_id", _credit().alias("score_credito"), _diversity().alias("score_diversidade"))


def score_credit(contas: DataFrame) -> DataFrame:
    sums = contas.groupBy("cliente_id").agg(
        F.sum("limite").alias("limite_total"), F.sum("saldo").alias("saldo_total")
    )
    return sums.select("cliente_id", _credit().alias("score_credito"))


def score_diversity(contas: DataFrame) -> DataFrame:
    kinds = contas.groupBy("cliente_id").agg(F.countDistinct("tipo_conta").alias("tipos_conta"))
    return kinds.select("cliente_id", _diversity().alias("score_diversidade"))


def customer_account_scores(contas: DataFrame, transacoes: DataFrame) -> DataFrame:
    """Account scores averaged over the customer's accounts that have them."""
    owner = contas.select(F.col("id").alias("conta_id"), "cliente_id").distinct()
    return (
        owner.join(account_scores(transacoes), "conta_id", "left")
        .groupBy("cliente_id")
        .agg(*[F.avg(c).alias(c) for c in ("score_comportamento", "score_atividade", "score_concentracao")])
    )


def risk_score(
    clientes: DataFrame,
    contas: DataFrame,
    transacoes: DataFrame,
    as_of: AsOf = None,
    weights: Mapping[str, float] = WEIGHTS,
    scale: int = 1,
) -> DataFrame:
    """Weighted score and level per customer; missing components count as 50.

    Components run from 0 to 100. The level cuts are on a 0 to 1000 scale: ``scale=10`` puts the
    score on it, ``scale=1`` leaves every customer in the highest level.
    """
    keep = [c for c in ("id", "nome", "cpf", "score_risco") if c in clientes.columns]
    joined = (
        clientes.select(*keep)
        .withColumnRenamed("id", "cliente_id")
        .join(customer_account_scores(contas, transacoes), "cliente_id", "left")
        .join(product_scores(contas), "cliente_id", "left")
        .withColumnRenamed("cliente_id", "id")
    )
    filled = neutral_fill(joined, [*weights, "score_risco"])
    total = None
    for name, weight in weights.items():
        term = F.col(name) * weight
        total = term if total is None else total + term
    return (
        filled.withColumn("score_risco_calculado", (total * scale).cast("int"))
        .withColumn("nivel_risco", nivel_risco(F.col("score_risco_calculado")))
        .withColumn("data_scoring", today(as_of))
        .withColumn("data_processamento", moment(as_of))
    )
