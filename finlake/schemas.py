"""Declared schemas of the entities, the change-data envelope and the type map."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(19, 4)

# Fields of a transaction message, in message order.
TRANSACAO = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("conta_id", T.LongType()),
    T.StructField("tipo_transacao", T.StringType()),
    T.StructField("valor", MONEY),
    T.StructField("data_transacao", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("canal", T.StringType()),
    T.StructField("dispositivo", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("cidade", T.StringType()),
    T.StructField("estado", T.StringType()),
    T.StructField("pais", T.StringType()),
    T.StructField("score_risco", T.FloatType()),
    T.StructField("aprovada", T.BooleanType()),
    T.StructField("tempo_processamento_ms", T.IntegerType()),
    T.StructField("created_at", T.TimestampType()),
])

# Short message read by the per-transaction scorer.
TRANSACAO_JSON = (
    "id long, conta_id long, tipo_transacao string, valor double, data_transacao string, "
    "status string, canal string, score_risco double"
)

EVENTO_NEGOCIO = (
    "eventId string, timestamp string, tipoTransacao string, eventType string, valor double, clienteId long"
)

# Column type names of the source database and the Spark type each one lands as.
TYPE_MAP: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "integer": T.IntegerType(),
    "smallint": T.ShortType(),
    "decimal": T.DecimalType(18, 4),
    "numeric": T.DecimalType(18, 4),
    "real": T.FloatType(),
    "double precision": T.DoubleType(),
    "varchar": T.StringType(),
    "text": T.StringType(),
    "timestamp": T.TimestampType(),
    "timestamp with time zone": T.TimestampType(),
    "date": T.DateType(),
    "boolean": T.ByteType(),
    "jsonb": T.StringType(),
}


def target_type(source_type: str) -> T.DataType:
    """Type a source column lands as; unknown names land as text."""
    return TYPE_MAP.get(source_type.strip().lower(), T.StringType())


def cdc_envelope(row: str) -> str:
    """DDL of a change event whose row image has the columns in ``row``."""
    return (
        f"before struct<{row}>, after struct<{row}>, "
        "source struct<db:string,schema:string,table:string,ts_ms:bigint>, op string, ts_ms bigint"
    )
