"""Staging, silver and gold models of accounts, customers and transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import AsOf, band, day_of_week, days_ago
from .enrich import FAIXA_VALOR, NIVEL_VOLUME

# Columns of the staged tables.
STG_CLIENTES = (
    "tipo_pessoa", "cpf", "nome", "cnpj", "nome_razao_social", "email", "telefone", "data_nascimento",
    "cidade", "estado", "cep", "status", "data_criacao", "data_atualizacao",
)
STG_CONTAS = (
    "id", "tenant_id", "numero_conta", "cliente_id", "tipo_conta", "saldo", "limite_credito", "limite_utilizado",
    "status", "data_abertura", "data_fechamento", "data_criacao", "data_atualizacao",
)
STG_TRANSACOES = (
    "id", "tenant_id", "conta_origem_id", "conta_destino_id", "tipo_transacao", "valor", "descricao", "status",
    "codigo_transacao", "data_transacao", "data_processamento", "data_criacao",
)


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def stg_clientes(clientes: DataFrame) -> DataFrame:
    return clientes.select(F.col("id").alias("cliente_id"), *_present(clientes, STG_CLIENTES))


def stg_contas(contas: DataFrame) -> DataFrame:
    return contas.select(*_present(contas, STG_CONTAS))


def stg_transacoes(transacoes: DataFrame) -> DataFrame:
    return transacoes.select(*_present(transacoes, STG_TRANSACOES))


def silver_contas(stg: DataFrame, status: str = "ATIVA") -> DataFrame:
    return stg.where(F.col("status") == status)


def silver_transacoes(stg: DataFrame) -> DataFrame:
    return stg.withColumns({
        "faixa_valor": band(F.col("valor"), FAIXA_VALOR, "BAIXO", strict=True),
        "hora_transacao": F.hour("data_transacao"),
        "dia_semana": day_of_week(F.col("data_transacao"), "postgres"),
    })


def silver_clientes(clientes: DataFrame, contas: DataFrame) -> DataFrame:
    """Staged customers with their account totals."""
    totals = contas.groupBy("cliente_id").agg(
        F.count(F.lit(1)).alias("total_contas"),
        F.sum("saldo").alias("saldo_total"),
        F.max("data_abertura").alias("ultima_conta_abertura"),
    )
    return clientes.join(totals, "cliente_id", "left").fillna(0, ["total_contas", "saldo_total"])


def gold_contas_resumo(contas: DataFrame) -> DataFrame:
    return contas.groupBy(F.date_trunc("day", "data_atualizacao").alias("data"), "tipo_conta", "status").agg(
        F.count(F.lit(1)).alias("total_contas"),
        F.sum("saldo").alias("saldo_total"),
        F.avg("saldo").alias("saldo_medio"),
        F.sum("limite_credito").alias("limite_total"),
        F.sum("limite_utilizado").alias("limite_utilizado_total"),
    )


def gold_transacoes_diarias(
    silver: DataFrame, status: str = "PROCESSADA", account: str = "conta_origem_id"
) -> DataFrame:
    return (
        silver.where(F.col("status") == status)
        .groupBy(F.date_trunc("day", "data_transacao").alias("data"), "tipo_transacao")
        .agg(
            F.count(F.lit(1)).alias("total_transacoes"),
            F.sum("valor").alias("volume_total"),
            F.avg("valor").alias("ticket_medio"),
            F.countDistinct(account).alias("contas_unicas"),
        )
    )


def customer_volume(
    silver: DataFrame, contas: DataFrame, as_of: AsOf = None, days: int = 30, account: str = "conta_origem_id"
) -> DataFrame:
    """Volume per customer of the last days.

    Transactions are summed per account and type first; only those sums meet the account owners.
    """
    per_account = (
        silver.where(F.col("data_transacao") >= days_ago(days, as_of))
        .groupBy(F.col(account).alias("conta_id"), "tipo_transacao")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("valor").alias("s"),
            F.count("valor").alias("c"),
            F.max("valor").alias("m"),
        )
    )
    owner = contas.select(F.col("id").alias("conta_id"), "cliente_id")
    return per_account.join(owner, "conta_id").groupBy("cliente_id").agg(
        F.sum("n").alias("total_transacoes_30d"),
        F.sum("s").alias("volume_30d"),
        F.when(F.sum("c") > 0, F.sum("s") / F.sum("c")).alias("ticket_medio_30d"),
        F.max("m").alias("maior_transacao_30d"),
        F.countDistinct("tipo_transacao").alias("tipos_utilizados"),
    )


def gold_clientes_risco(
    clientes: DataFrame, silver: DataFrame, contas: DataFrame, as_of: AsOf = None, account: str = "conta_origem_id"
) -> DataFrame:
    """Silver customers with their recent volume and its level."""
    volume = customer_volume(silver, contas, as_of, account=account)
    joined = clientes.join(volume, "cliente_id", "left").fillna(0, ["total_transacoes_30d", "volume_30d"])
    return joined.withColumn("nivel_risco_volume", band(F.col("volume_30d"), NIVEL_VOLUME, "BAIXO", strict=True))
