"""Row-level projections, filters and type normalisation (no shuffle anywhere)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    AsOf,
    ago,
    band,
    business_hours,
    day_of_week,
    days_ago,
    flag,
    is_night,
    is_weekend,
    moment,
    today,
)
from ..schemas import TRANSACAO_JSON

# Cuts and labels of the bands.
CLASSE_RISCO = [(800, "A"), (600, "B"), (400, "C")]
NIVEL_RISCO = [(750, "BAIXO"), (500, "MEDIO"), (250, "ALTO")]
FAIXA_VALOR = [(50000, "ALTO"), (10000, "MEDIO")]
NIVEL_VOLUME = [(100000, "ALTO"), (50000, "MEDIO")]


def enrich_transactions(df: DataFrame, high_value: float = 1000) -> DataFrame:
    ts = F.col("data_transacao")
    return df.withColumns({
        "hora": F.hour(ts),
        "dia_semana": day_of_week(ts),
        "mes": F.month(ts),
        "ano": F.year(ts),
        "valor_alto": flag(F.col("valor") > high_value),
        "horario_comercial": flag(business_hours(ts)),
        "fim_de_semana": flag(is_weekend(ts)),
    })


def risk_points(valor: Column, ts: Column, canal: Column) -> Column:
    """Additive risk of one transaction, at most 1."""
    points = (
        F.when(valor > 5000, 0.3).otherwise(0.0)
        + F.when(is_night(ts), 0.2).otherwise(0.0)
        + F.when(is_weekend(ts), 0.1).otherwise(0.0)
        + F.when(canal == "MOBILE", 0.1).otherwise(0.0)
    )
    return F.least(points, F.lit(1.0))


def score_transaction(df: DataFrame, as_of: AsOf = None, high_value: float = 1000) -> DataFrame:
    ts = F.col("data_transacao")
    return df.withColumns({
        "processed_at": moment(as_of),
        "hour": F.hour(ts),
        "day_of_week": day_of_week(ts, "python"),
        "is_high_value": flag(F.col("valor") > high_value),
        "is_business_hours": flag(business_hours(ts)),
        "is_weekend": flag(is_weekend(ts)),
        "calculated_risk_score": risk_points(F.col("valor"), ts, F.col("canal")),
    })


SCORED_FIELDS = (
    "processed_at", "hour", "day_of_week", "is_high_value", "is_business_hours", "is_weekend", "calculated_risk_score",
)


def score_messages(messages: DataFrame, as_of: AsOf = None, value: str = "value") -> DataFrame:
    """JSON message in, scored JSON message out; a malformed message passes through unchanged.

    The scored fields are put next to the fields the message already has and replace those of the
    same name. A message without channel is scored without the channel's points.
    """
    data = F.from_json(F.col(value), TRANSACAO_JSON)
    ts = F.try_to_timestamp(data["data_transacao"])
    usable = F.coalesce(ts.isNotNull() & data["valor"].isNotNull(), F.lit(False))
    scored = F.struct(
        F.date_format(moment(as_of), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processed_at"),
        F.hour(ts).alias("hour"),
        day_of_week(ts, "python").alias("day_of_week"),
        flag(data["valor"] > 1000).alias("is_high_value"),
        flag(business_hours(ts)).alias("is_business_hours"),
        flag(is_weekend(ts)).alias("is_weekend"),
        risk_points(data["valor"], ts, data["canal"]).alias("calculated_risk_score"),
    )
    fields = "map<string, variant>"
    own = F.map_filter(F.from_json(F.col(value), fields), lambda k, _: ~k.isin(*SCORED_FIELDS))
    merged = F.to_json(F.map_concat(own, F.from_json(F.to_json(scored), fields)))
    return messages.withColumns({
        "malformed": ~usable,
        value: F.when(usable, merged).otherwise(F.col(value)),
    })


def is_suspicious(df: DataFrame) -> Column:
    """Night, a large round value, or a large value at the weekend."""
    ts, valor = F.col("data_transacao"), F.col("valor")
    return (
        is_night(ts)
        | ((valor % 1000 == 0) & (valor > 10000))
        | (is_weekend(ts) & (valor > 5000))
    )


def pix_analytics(df: DataFrame, as_of: AsOf = None, status: str = "AUTORIZADA") -> DataFrame:
    ts = F.col("data_transacao")
    return df.where((F.col("tipo_transacao") == "PIX") & (F.col("status") == status)).select(
        "id", "conta_id", "valor", "data_transacao", "canal", "cidade", "estado", "score_risco",
        F.hour(ts).alias("hora_dia"),
        is_weekend(ts).alias("is_fim_de_semana"),
        business_hours(ts, 8, 18).alias("is_horario_comercial"),
        moment(as_of).alias("data_processamento"),
    )


def raw_events(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    return df.select(
        "id", "conta_id", "tipo_transacao", "valor", "data_transacao", "status", "canal", "score_risco",
        moment(as_of).alias("processado_em"),
    )


def base_customer(clientes: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Customer columns with age and tenure; optional identity columns are kept when present."""
    optional = [c for c in ("cpf", "nome", "email") if c in clientes.columns]
    return clientes.select(
        "id",
        *optional,
        (F.datediff(today(as_of), "data_nascimento") / 365.25).cast("int").alias("idade"),
        F.datediff(today(as_of), "created_at").alias("tempo_como_cliente_dias"),
        "score_risco",
        "status",
        F.col("created_at").alias("data_cadastro"),
    )


def last_n_days(df: DataFrame, n: int, as_of: AsOf = None, ts: str = "data_transacao") -> DataFrame:
    """From midnight ``n`` days ago; there is no upper bound."""
    return df.where(F.col(ts) >= days_ago(n, as_of))


def last_n_minutes(df: DataFrame, n: int, as_of: AsOf = None, ts: str = "data_transacao") -> DataFrame:
    return df.where(F.col(ts) >= ago(f"{n} minutes", as_of))


def neutral_fill(df: DataFrame, columns: Sequence[str], value: int = 50) -> DataFrame:
    return df.fillna(value, subset=list(columns))


# Columns normalised by name.
TIMESTAMP_COLUMNS = ("data_transacao", "data_atualizacao", "data_criacao", "created_at")
DECIMAL_COLUMNS = ("valor", "saldo", "limite_credito", "taxa_juros")
BOOLEAN_COLUMNS = ("aprovada", "ativa", "bloqueada")
JSON_COLUMNS = ("dados_extras", "configuracoes", "detalhes")


def normalize_types(df: DataFrame) -> DataFrame:
    """Unreadable timestamps become NULL, unreadable amounts 0, booleans 0/1, JSON text."""
    out = {}
    for name in df.columns:
        kind = df.schema[name].dataType.typeName()
        value = F.col(name)
        if name in TIMESTAMP_COLUMNS:
            out[name] = F.try_to_timestamp(value) if kind == "string" else value.try_cast("timestamp")
        elif name in DECIMAL_COLUMNS:
            number = value.try_cast("double") if kind == "string" else value
            out[name] = F.coalesce(number, F.lit(0).cast(df.schema[name].dataType if kind != "string" else "double"))
        elif name in BOOLEAN_COLUMNS:
            out[name] = F.coalesce(value.try_cast("boolean").cast("int"), F.lit(0))
        elif name in JSON_COLUMNS and kind in ("struct", "map", "array"):
            out[name] = F.to_json(value)
        elif name in JSON_COLUMNS:
            out[name] = value.cast("string")
    return df.withColumns(out) if out else df


def classe_risco(score: Column) -> Column:
    return band(score, CLASSE_RISCO, "D")


def nivel_risco(score: Column) -> Column:
    return band(score, NIVEL_RISCO, "MUITO_ALTO")
