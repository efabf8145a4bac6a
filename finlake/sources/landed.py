"""Landed JSON payloads: business events, market series, bond prices, dead letters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import AsOf, moment
from ..schemas import EVENTO_NEGOCIO

# Series code of each market indicator.
SERIES = {"CDI": 4389, "IPCA": 433, "SELIC": 432, "USD_BRL": 1, "IBOVESPA": 7832}

# Bond name to investment type.
BOND_TYPES = {
    "Tesouro Selic": "TESOURO_SELIC",
    "Tesouro IPCA+": "TESOURO_IPCA",
    "Tesouro IPCA+ com Juros Semestrais": "TESOURO_IPCA",
    "Tesouro Prefixado": "TESOURO_PREFIXADO",
    "Tesouro Prefixado com Juros Semestrais": "TESOURO_PREFIXADO",
    "Tesouro RendA+": "TESOURO_RENDA_MAIS",
}


def literal_map(entries: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def project_event_envelope(messages: DataFrame, as_of: AsOf = None, value: str = "value") -> DataFrame:
    """Normalised business event; ``offset`` stands in for a missing event id.

    A missing time is the evaluation time; a time that cannot be read stays NULL, for the dead letters.
    """
    event = F.from_json(F.col(value).cast("string"), EVENTO_NEGOCIO)
    parsed = messages.select("offset", event.alias("e"))

    def filled(name: str) -> Column:
        return F.nullif(F.col(f"e.{name}"), F.lit(""))

    return parsed.select(
        F.coalesce(filled("eventId"), F.col("offset").cast("string")).alias("transaction_id"),
        F.when(filled("timestamp").isNull(), moment(as_of)).otherwise(F.col("e.timestamp").try_cast("timestamp")).alias("timestamp"),
        F.coalesce(filled("tipoTransacao"), F.col("e.eventType"), F.lit("DESCONHECIDO")).alias("tipo"),
        F.coalesce(F.col("e.valor"), F.lit(0.0)).alias("valor"),
        F.coalesce(F.col("e.clienteId"), F.lit(0)).alias("cliente_id"),
    )


def dead_letter(required: Sequence[str]) -> Column:
    """True for a record that misses a required field."""
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    return missing


def split_dlq(
    df: DataFrame, required: Sequence[str] = ("transaction_id", "timestamp", "tipo", "valor")
) -> tuple[DataFrame, DataFrame]:
    """(valid, dead letters)."""
    bad = dead_letter(required)
    return df.where(~bad), df.where(bad)


def market_indicators(
    payloads: DataFrame,
    as_of: AsOf = None,
    series: Mapping[str, int] = SERIES,
    source: str = "bcb_api",
    payload: str = "payload",
) -> DataFrame:
    """Last value of each landed series ``[{data, valor}, ...]``; empty series give no row."""
    points = F.from_json(F.col(payload), "array<struct<data string, valor string>>")
    last = F.try_element_at(points, F.lit(-1))
    return (
        payloads.withColumn("ultimo", last["valor"].try_cast("double"))
        .where(F.col("ultimo").isNotNull())
        .withColumn("serie", literal_map(series)[F.col("indicador")])
        .where(F.col("serie").isNotNull())
        .select(
            (F.col("tempo") if "tempo" in payloads.columns else moment(as_of)).alias("tempo"),
            "indicador",
            F.col("ultimo").cast("decimal(15,6)").alias("valor"),
            F.create_map(F.lit("source"), F.lit(source), F.lit("series_id"), F.col("serie").cast("string")).alias(
                "labels"
            ),
        )
    )


def bond_prices(payloads: DataFrame, as_of: AsOf = None, payload: str = "payload") -> DataFrame:
    """Typed bond quotes; quotes without a positive buying price are dropped."""
    quote = F.from_json(
        F.col(payload), "nmTitulo string, puCompraManha double, puVendaManha double, taxaCompraManha double"
    )
    q = payloads.withColumn("q", quote)

    def number(name: str) -> Column:
        return F.coalesce(F.col(f"q.{name}"), F.lit(0.0))

    name = F.coalesce(F.col("q.nmTitulo"), F.lit(""))
    return q.where(number("puCompraManha") > 0).select(
        (F.col("tempo") if "tempo" in payloads.columns else moment(as_of)).alias("tempo"),
        name.alias("ativo_id"),
        F.coalesce(literal_map(BOND_TYPES)[name], F.lit("TESOURO_OUTROS")).alias("tipo_investimento"),
        number("puCompraManha").cast("decimal(15,2)").alias("preco_unitario_compra"),
        number("puVendaManha").cast("decimal(15,2)").alias("preco_unitario_venda"),
        (number("taxaCompraManha") / 100.0).cast("decimal(10,6)").alias("taxa_indicativa"),
    )
