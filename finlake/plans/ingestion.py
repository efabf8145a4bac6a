"""Queries over change data, keyed tables, retention and landed payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sinks
from ..operators.latest import latest_by_key, upsert
from ..sources import cdc, incremental, landed
from ..sources.testdata import contas, eventos, table
from ..tables import merge_rows
from .registry import BANK_DAY, EVENT_DAY, query, sql

CDC_ROW = "user_id long, event_id long, value double"


def _messages(spark, d):
    """Change events: errors are deletes; messages of small values are unusable in one of three ways."""
    image = F.struct("user_id", "event_id", "value")
    gone = F.col("event_type") == "error"
    ms = F.unix_millis("ts")
    envelope = F.to_json(
        F.struct(
            F.when(gone, image).alias("before"),
            F.when(~gone, image).alias("after"),
            F.struct(ms.alias("ts_ms")).alias("source"),
            F.when(gone, "d").when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "view", None)
            .otherwise("u").alias("op"),
            F.when(F.col("event_type") != "click", ms).alias("ts_ms"),
        )
    )
    broken = (
        F.when(F.col("value") < 1, F.lit(None).cast("string"))
        .when(F.col("value") < 2, F.lit("{broken"))
        .when(F.col("value") < 3, F.lit('{"op": "r", "after": null}'))
        .otherwise(envelope)
    )
    return table(spark, d, "events").select(F.col("event_id").alias("offset"), broken.alias("value"))


PARSED = """
    SELECT event_id, user_id, value,
           CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS _cdc_op,
           date_trunc('millisecond', ts) AS t, event_type = 'error' AS _cdc_deleted
    FROM events WHERE value >= 3"""
ISO = """CASE WHEN extract(microsecond FROM t) % 1000000 = 0 THEN strftime(t, '%Y-%m-%dT%H:%M:%S+00:00')
    ELSE strftime(t, '%Y-%m-%dT%H:%M:%S.%f+00:00') END"""


@query("cdc_parse", sql(
    "user_id:i event_id:i value:r _cdc_op:s _cdc_ts:s _cdc_deleted:b",
    f"SELECT user_id, event_id, value, _cdc_op, {ISO} AS _cdc_ts, _cdc_deleted FROM ({PARSED})"))
def _(spark, d):
    return cdc.parse_cdc(_messages(spark, d), CDC_ROW).drop("offset")


@query("cdc_apply", sql(
    "user_id:i event_id:i value:r", f"""
    SELECT user_id, event_id, value FROM ({PARSED})
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY t DESC, event_id DESC) = 1 AND NOT _cdc_deleted"""))
def _(spark, d):
    changes = cdc.parse_cdc(_messages(spark, d), CDC_ROW)
    return cdc.apply_cdc(changes, ["user_id"], ["_cdc_ts", "offset"]).drop("offset")


@query("upsert", sql(
    "id:i saldo:r status:s", """
    SELECT id, saldo, status FROM contas WHERE id NOT IN (SELECT user_id FROM events)
    UNION ALL
    SELECT user_id AS id, value AS saldo, event_type AS status FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""))
def _(spark, d):
    updates = table(spark, d, "events").select(
        F.col("user_id").alias("id"), F.col("value").alias("saldo"), F.col("event_type").alias("status"), "ts"
    )
    return upsert(contas(spark, d).select("id", "saldo", "status"), updates, ["id"], ["ts"])


@query("upsert_merge", sql(
    "id:i saldo:r status:s", """
    SELECT id, saldo, status FROM contas WHERE id NOT IN (SELECT user_id FROM events)
    UNION ALL
    SELECT user_id AS id, value AS saldo, event_type AS status FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""))
def _(spark, d):
    updates = table(spark, d, "events").select(
        F.col("user_id").alias("id"), F.col("value").alias("saldo"), F.col("event_type").alias("status"), "ts"
    )
    return merge_rows(contas(spark, d).select("id", "saldo", "status"), updates, ["id"], ["ts"])


@query("latest_by_key", sql(
    "conta_id:i id:i valor:r", """
    SELECT conta_id, id, valor FROM eventos
    QUALIFY row_number() OVER (PARTITION BY conta_id ORDER BY data_transacao DESC) = 1"""))
def _(spark, d):
    rows = eventos(spark, d).select("conta_id", "id", "valor", "data_transacao")
    return latest_by_key(rows, ["conta_id"], ["data_transacao"]).drop("data_transacao")


@query("incremental_extract", sql(
    "id:i cliente_id:i data_atualizacao:t",
    "SELECT id, cliente_id, data_atualizacao FROM contas WHERE data_atualizacao > TIMESTAMP '1999-06-30'"))
def _(spark, d):
    return incremental.incremental_extract(contas(spark, d), "1999-06-30").select("id", "cliente_id", "data_atualizacao")


@query("next_watermark", sql("watermark:t", "SELECT max(data_atualizacao) AS watermark FROM contas"))
def _(spark, d):
    return incremental.next_watermark(contas(spark, d))


@query("sync_changes", sql(
    "id:i saldo:r data_atualizacao:t",
    f"SELECT id, saldo, data_atualizacao FROM contas WHERE data_atualizacao > TIMESTAMP '{BANK_DAY}' - INTERVAL 365 DAY"))
def _(spark, d):
    rows = sinks.changed_since(contas(spark, d), since="2000-11-05")
    return rows.select("id", "saldo", "data_atualizacao")


@query("analytics_table", sql(
    "id:i saldo:r status:s created_at:t",
    f"SELECT id, saldo, status, TIMESTAMP '{BANK_DAY}' AS created_at FROM contas"))
def _(spark, d):
    types = {"id": "bigint", "saldo": "numeric", "status": "varchar"}
    return sinks.analytics_table(contas(spark, d).select("id", "saldo", "status"), types, BANK_DAY)


@query("purge_expired", sql(
    "id:i data_atualizacao:t",
    f"SELECT id, data_atualizacao FROM contas WHERE NOT data_atualizacao < TIMESTAMP '{BANK_DAY}' - INTERVAL 1825 DAY"))
def _(spark, d):
    return sinks.purge_expired(contas(spark, d), 1825, BANK_DAY).select("id", "data_atualizacao")


@query("purge_counts", sql(
    "tabela:s removidos:i", f"""
    SELECT 'cliente_pf' AS tabela, 0 AS removidos UNION ALL SELECT 'cliente_pj', 0
    UNION ALL SELECT 'auditoria', count(*) FROM events WHERE ts < TIMESTAMP '{BANK_DAY}' - INTERVAL 1825 DAY
    UNION ALL SELECT 'transacao', count(*) FROM contas WHERE data_atualizacao < TIMESTAMP '{BANK_DAY}' - INTERVAL 1825 DAY"""))
def _(spark, d):
    log = table(spark, d, "events").withColumnRenamed("ts", "data_atualizacao")
    return sinks.purge_counts({"auditoria": log, "transacao": contas(spark, d)}, BANK_DAY)


def _business_messages(spark, d):
    """Business events in which some fields are missing or empty."""
    kind, key = F.col("event_type"), F.col("event_id")
    body = F.to_json(
        F.struct(
            F.when(kind == "view", "").when(kind == "click", None).otherwise(F.concat(F.lit("E"), key)).alias("eventId"),
            F.when(kind != "signup", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("timestamp"),
            F.when(kind == "purchase", "PIX").when(kind == "error", "").alias("tipoTransacao"),
            F.when(kind == "error", "TED").alias("eventType"),
            F.when(kind != "error", F.col("value")).alias("valor"),
            F.when(kind != "view", F.col("user_id")).alias("clienteId"),
        )
    )
    return table(spark, d, "events").select(key.alias("offset"), body.alias("value"))


@query("project_event_envelope", sql(
    "transaction_id:s timestamp:t tipo:s valor:r cliente_id:i", f"""
    SELECT CASE WHEN event_type IN ('view', 'click') THEN CAST(event_id AS VARCHAR) ELSE 'E' || event_id END AS transaction_id,
           CASE WHEN event_type = 'signup' THEN TIMESTAMP '{EVENT_DAY}' ELSE ts END AS timestamp,
           CASE event_type WHEN 'purchase' THEN 'PIX' WHEN 'error' THEN 'TED' ELSE 'DESCONHECIDO' END AS tipo,
           CASE WHEN event_type = 'error' THEN 0 ELSE value END AS valor,
           CASE WHEN event_type = 'view' THEN 0 ELSE user_id END AS cliente_id
    FROM events"""))
def _(spark, d):
    return landed.project_event_envelope(_business_messages(spark, d), EVENT_DAY)


def _holed(spark, d):
    kind = F.col("event_type")
    return table(spark, d, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.when(kind != "signup", F.col("ts")).alias("timestamp"),
        kind.alias("tipo"),
        F.when(kind != "error", F.col("value")).alias("valor"),
    )


@query("dlq_valid", sql(
    "transaction_id:i timestamp:t tipo:s valor:r", """
    SELECT event_id AS transaction_id, ts AS timestamp, event_type AS tipo, value AS valor FROM events
    WHERE event_type NOT IN ('signup', 'error')"""))
def _(spark, d):
    return landed.split_dlq(_holed(spark, d))[0]


@query("dlq_rejected", sql(
    "transaction_id:i timestamp:t tipo:s valor:r", """
    SELECT event_id AS transaction_id, CASE WHEN event_type <> 'signup' THEN ts END AS timestamp, event_type AS tipo,
           CASE WHEN event_type <> 'error' THEN value END AS valor FROM events WHERE event_type IN ('signup', 'error')"""))
def _(spark, d):
    return landed.split_dlq(_holed(spark, d))[1]


@query("market_indicators", sql(
    "tempo:t indicador:s valor:r serie:s", """
    SELECT ts AS tempo, CASE event_type WHEN 'purchase' THEN 'CDI' WHEN 'click' THEN 'SELIC' ELSE 'IPCA' END AS indicador,
           round(value + 1, 2) AS valor, CASE event_type WHEN 'purchase' THEN '4389' WHEN 'click' THEN '432' ELSE '433' END AS serie
    FROM events WHERE event_type NOT IN ('error', 'signup')"""))
def _(spark, d):
    kind = F.col("event_type")
    def text(c):
        return F.struct(F.lit("01/01/2024").alias("data"), c.cast("string").alias("valor"))

    points = F.array(text(F.col("value")), text(F.round(F.col("value") + 1, 2)))
    empty = F.lit("[]")
    payloads = table(spark, d, "events").select(
        F.col("ts").alias("tempo"),
        F.when(kind == "purchase", "CDI").when(kind == "click", "SELIC").when(kind == "signup", "NENHUM")
        .otherwise("IPCA").alias("indicador"),
        F.when(kind == "error", empty).otherwise(F.to_json(points)).alias("payload"),
    )
    found = landed.market_indicators(payloads)
    return found.select("tempo", "indicador", "valor", F.col("labels")["series_id"].alias("serie"))


@query("bond_prices", sql(
    "tempo:t ativo_id:s tipo_investimento:s preco_unitario_compra:r preco_unitario_venda:r taxa_indicativa:r", """
    SELECT ts AS tempo,
           CASE event_type WHEN 'purchase' THEN 'Tesouro Selic' WHEN 'click' THEN 'Tesouro IPCA+ com Juros Semestrais'
                           WHEN 'view' THEN 'Tesouro Educa+' ELSE '' END AS ativo_id,
           CASE event_type WHEN 'purchase' THEN 'TESOURO_SELIC' WHEN 'click' THEN 'TESOURO_IPCA' ELSE 'TESOURO_OUTROS' END AS tipo_investimento,
           value AS preco_unitario_compra, CASE WHEN event_type = 'view' THEN 0 ELSE value END AS preco_unitario_venda,
           (event_id % 1300) / 10000.0e0 AS taxa_indicativa
    FROM events WHERE event_type <> 'error' AND value > 0"""))
def _(spark, d):
    kind = F.col("event_type")
    name = (
        F.when(kind == "purchase", "Tesouro Selic").when(kind == "click", "Tesouro IPCA+ com Juros Semestrais")
        .when(kind == "view", "Tesouro Educa+")
    )
    body = F.to_json(
        F.struct(
            name.alias("nmTitulo"),
            F.when(kind != "error", F.col("value")).alias("puCompraManha"),
            F.when(kind != "view", F.col("value")).alias("puVendaManha"),
            ((F.col("event_id") % 1300) / 100).alias("taxaCompraManha"),
        )
    )
    return landed.bond_prices(table(spark, d, "events").select(F.col("ts").alias("tempo"), body.alias("payload")))


@query("alert_messages", sql(
    "chave:s id:i conta_id:i valor:r status:s canal:s aprovada:s",
    "SELECT conta_id AS chave, id, conta_id, valor, status, canal, CAST(aprovada AS VARCHAR) AS aprovada FROM eventos"))
def _(spark, d):
    """What a reader of the topic finds in every message."""
    messages = sinks.as_messages(eventos(spark, d), "conta_id")

    def field(name: str, kind: str = "string"):
        return F.get_json_object("value", f"$.{name}").cast(kind).alias(name)

    return messages.select(
        F.col("key").alias("chave"), field("id", "long"), field("conta_id", "long"), field("valor", "double"),
        field("status"), field("canal"), field("aprovada"),
    )


@query("envelope_bad_times", sql(
    "transaction_id:s timestamp:t rejeitado:b", """
    SELECT CAST(event_id AS VARCHAR) AS transaction_id, CASE WHEN event_id % 4 <> 0 THEN ts END AS timestamp,
           event_id % 4 = 0 AS rejeitado
    FROM events"""))
def _(spark, d):
    """Every fourth event has a time nobody can read: it is a dead letter, not the end of the query."""
    when = F.when(F.col("event_id") % 4 == 0, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    body = F.to_json(F.struct(F.col("event_id").cast("string").alias("eventId"), when.alias("timestamp"), F.lit("PIX").alias("eventType")))
    rows = landed.project_event_envelope(table(spark, d, "events").select(F.col("event_id").alias("offset"), body.alias("value")), EVENT_DAY)
    return rows.select("transaction_id", "timestamp", landed.dead_letter(["timestamp"]).alias("rejeitado"))


@query("cdc_topics", sql(
    "topico:s id:i saldo:r canal:s valor:r", """
    SELECT 'cdc.contas' AS topico, event_id AS id, value AS saldo, NULL AS canal, NULL AS valor FROM events WHERE event_id % 2 = 0
    UNION ALL
    SELECT 'cdc.transacoes', event_id, NULL, event_type, value FROM events WHERE event_id % 3 = 0 AND event_id % 2 <> 0"""))
def _(spark, d):
    """Two topics whose rows have different columns, and one that nobody asked for."""
    key = F.col("event_id")
    account = F.to_json(F.struct(F.lit("c").alias("op"), F.struct(key.alias("id"), F.col("value").alias("saldo")).alias("after")))
    payment = F.to_json(F.struct(F.lit("c").alias("op"), F.struct(key.alias("id"), F.col("event_type").alias("canal"), F.col("value").alias("valor")).alias("after")))
    messages = table(spark, d, "events").select(
        F.when(key % 2 == 0, "cdc.contas").when(key % 3 == 0, "cdc.transacoes").otherwise("cdc.outros").alias("topic"),
        F.when(key % 2 == 0, account).otherwise(payment).alias("value"),
    )
    parsed = cdc.parse_topics(messages, {"cdc.contas": "id long, saldo double", "cdc.transacoes": "id long, canal string, valor double"})
    both = parsed["cdc.contas"].unionByName(parsed["cdc.transacoes"], allowMissingColumns=True)
    return both.select(F.col("topic").alias("topico"), "id", "saldo", "canal", "valor")
