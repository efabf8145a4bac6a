"""Queries over transactions, accounts and customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.extras import Extras
from ..operators import enrich, medallion, metrics, profile, reports, risk
from ..sources.testdata import clientes, contas, eventos, eventos_risco, table, transacoes
from .registry import BANK_DAY, EVENT_DAY, query, sql

HOUR = "extract(hour FROM data_transacao)"
DOW = "extract(dow FROM data_transacao)"
NIGHT = f"({HOUR} < 6 OR {HOUR} > 22)"
WEEKEND = f"({DOW} IN (0, 6))"


@query("enrich_transactions", sql(
    "id:i hora:i dia_semana:i mes:i ano:i valor_alto:i horario_comercial:i fim_de_semana:i", f"""
    SELECT id, {HOUR} AS hora, {DOW} + 1 AS dia_semana, month(data_transacao) AS mes, year(data_transacao) AS ano,
           CASE WHEN valor > 1000 THEN 1 ELSE 0 END AS valor_alto,
           CASE WHEN {HOUR} BETWEEN 9 AND 18 THEN 1 ELSE 0 END AS horario_comercial,
           CASE WHEN {WEEKEND} THEN 1 ELSE 0 END AS fim_de_semana
    FROM eventos"""))
def _(spark, d):
    return enrich.enrich_transactions(eventos(spark, d)).select(
        "id", "hora", "dia_semana", "mes", "ano", "valor_alto", "horario_comercial", "fim_de_semana"
    )


POINTS = f"""(CASE WHEN valor > 5000 THEN 0.3e0 ELSE 0 END + CASE WHEN {NIGHT} THEN 0.2e0 ELSE 0 END
    + CASE WHEN {WEEKEND} THEN 0.1e0 ELSE 0 END + CASE WHEN canal = 'MOBILE' THEN 0.1e0 ELSE 0 END)"""


@query("score_transaction", sql(
    "id:i processed_at:t hour:i day_of_week:i is_high_value:i is_business_hours:i is_weekend:i calculated_risk_score:r",
    f"""
    SELECT id, TIMESTAMP '{EVENT_DAY}' AS processed_at, {HOUR} AS hour, ({DOW} + 6) % 7 AS day_of_week,
           CASE WHEN valor > 1000 THEN 1 ELSE 0 END AS is_high_value,
           CASE WHEN {HOUR} BETWEEN 9 AND 18 THEN 1 ELSE 0 END AS is_business_hours,
           CASE WHEN {WEEKEND} THEN 1 ELSE 0 END AS is_weekend, least({POINTS}, 1.0e0) AS calculated_risk_score
    FROM eventos"""))
def _(spark, d):
    return enrich.score_transaction(eventos(spark, d), EVENT_DAY).select(
        "id", "processed_at", "hour", "day_of_week", "is_high_value", "is_business_hours", "is_weekend",
        "calculated_risk_score",
    )


@query("score_messages", sql(
    "id:i malformed:b risco:r", f"""
    SELECT id, status = 'REJEITADA' AS malformed,
           CASE WHEN status = 'REJEITADA' THEN NULL ELSE least({POINTS}, 1.0e0) END AS risco
    FROM eventos"""))
def _(spark, d):
    message = F.to_json(
        F.struct("id", "conta_id", "tipo_transacao", "valor", "status", "canal", "score_risco",
                 F.date_format("data_transacao", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("data_transacao"))
    )
    broken = F.when(F.col("status") == "REJEITADA", F.lit("not-json-at-all")).otherwise(message)
    scored = enrich.score_messages(eventos(spark, d).select("id", broken.alias("value")), EVENT_DAY)
    score = F.get_json_object("value", "$.calculated_risk_score").cast("double")
    return scored.select("id", "malformed", score.alias("risco"))


@query("score_messages_again", sql(
    "id:i malformed:b risco:r hora:i campos:i extra:s", f"""
    SELECT id, false AS malformed, round(least({POINTS.replace("canal = 'MOBILE'", "canal = 'MOBILE' AND id % 5 <> 0")}, 1.0e0), 6) AS risco,
           {HOUR} AS hora, 12 AS campos, 'x' || id AS extra
    FROM eventos"""))
def _(spark, d):
    """Messages that were scored before, some without channel; the new fields replace the old ones."""
    message = F.to_json(
        F.struct("id", "valor", F.when(F.col("id") % 5 != 0, F.col("canal")).alias("canal"), F.lit(0.9).alias("calculated_risk_score"),
                 F.lit(99).alias("hour"), F.concat(F.lit("x"), "id").alias("extra"),
                 F.date_format("data_transacao", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("data_transacao")),
        {"ignoreNullFields": "false"},
    )
    scored = enrich.score_messages(eventos(spark, d).select("id", message.alias("value")), EVENT_DAY)

    def field(name: str):
        return F.get_json_object("value", f"$.{name}")

    return scored.select(
        "id", "malformed", field("calculated_risk_score").cast("double").alias("risco"), field("hour").cast("int").alias("hora"),
        F.size(F.json_object_keys("value")).alias("campos"), field("extra").alias("extra"),
    )


@query("pix_analytics", sql(
    "id:i hora_dia:i is_fim_de_semana:b is_horario_comercial:b valor:r data_transacao:t", f"""
    SELECT id, {HOUR} AS hora_dia, {WEEKEND} AS is_fim_de_semana, {HOUR} BETWEEN 8 AND 18 AS is_horario_comercial,
           valor, data_transacao
    FROM eventos WHERE tipo_transacao = 'PIX' AND status = 'AUTORIZADA'"""))
def _(spark, d):
    return enrich.pix_analytics(eventos(spark, d), EVENT_DAY).select(
        "id", "hora_dia", "is_fim_de_semana", "is_horario_comercial", "valor", "data_transacao"
    )


@query("raw_events", sql(
    "id:i conta_id:i tipo_transacao:s valor:r data_transacao:t status:s canal:s score_risco:r processado_em:t", f"""
    SELECT id, conta_id, tipo_transacao, valor, data_transacao, status, canal, score_risco,
           TIMESTAMP '{EVENT_DAY}' AS processado_em FROM eventos"""))
def _(spark, d):
    return enrich.raw_events(eventos(spark, d), EVENT_DAY)


@query("base_customer", sql(
    "id:i nome:s idade:i tempo_como_cliente_dias:i score_risco:r status:s data_cadastro:d", f"""
    SELECT id, nome, trunc((DATE '{BANK_DAY}' - data_nascimento) / 365.25e0) AS idade,
           DATE '{BANK_DAY}' - created_at AS tempo_como_cliente_dias, score_risco, status, created_at AS data_cadastro
    FROM clientes"""))
def _(spark, d):
    return enrich.base_customer(clientes(spark, d), BANK_DAY)


@query("suspicious_transactions", sql(
    "id:i conta_id:i valor:r", f"""
    SELECT id, conta_id, valor FROM eventos
    WHERE {NIGHT} OR (valor % 1000 = 0 AND valor > 10000) OR ({WEEKEND} AND valor > 5000)"""))
def _(spark, d):
    rows = eventos(spark, d)
    return rows.where(enrich.is_suspicious(rows)).select("id", "conta_id", "valor")


@query("last_n_days", sql(
    "id:i valor:r", f"SELECT id, valor FROM transacoes WHERE data_transacao >= DATE '{BANK_DAY}' - 90"))
def _(spark, d):
    return enrich.last_n_days(transacoes(spark, d), 90, BANK_DAY).select("id", "valor")


@query("normalize_types", sql(
    "id:i data_transacao:t valor:r aprovada:i detalhes:s", """
    SELECT event_id AS id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS data_transacao,
           CASE WHEN event_type = 'view' THEN 0 ELSE value END AS valor,
           CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS aprovada, '{"k":' || (event_id % 9) || '}' AS detalhes
    FROM events"""))
def _(spark, d):
    kind = F.col("event_type")
    raw = table(spark, d, "events").select(
        F.col("event_id").alias("id"),
        F.when(kind == "error", "no time").otherwise(F.col("ts").cast("string")).alias("data_transacao"),
        F.when(kind == "view", "n/a").otherwise(F.col("value").cast("string")).alias("valor"),
        F.when(kind == "click", F.lit(True)).when(kind == "view", F.lit(False)).alias("aprovada"),
        F.struct((F.col("event_id") % 9).alias("k")).alias("detalhes"),
    )
    return enrich.normalize_types(raw)


# --- medallion ------------------------------------------------------------------------------


def _staged_transactions(spark, d):
    return medallion.stg_transacoes(transacoes(spark, d).withColumnRenamed("conta_id", "conta_origem_id"))


def _staged_accounts(spark, d):
    limits = {"limite_credito": F.col("limite"), "limite_utilizado": F.least("saldo", "limite")}
    return medallion.stg_contas(contas(spark, d).withColumns(limits))


def _silver_customers(spark, d):
    staged = medallion.stg_clientes(clientes(spark, d))
    return medallion.silver_clientes(staged, _staged_accounts(spark, d))


@query("staging_customers", sql(
    "cliente_id:i nome:s data_nascimento:d status:s",
    "SELECT id AS cliente_id, nome, data_nascimento, status FROM clientes"))
def _(spark, d):
    return medallion.stg_clientes(clientes(spark, d))


@query("silver_transactions", sql(
    "id:i conta_origem_id:i tipo_transacao:s valor:r status:s data_transacao:t faixa_valor:s hora_transacao:i dia_semana:i",
    f"""
    SELECT id, conta_id AS conta_origem_id, tipo_transacao, valor, status, data_transacao,
           CASE WHEN valor > 50000 THEN 'ALTO' WHEN valor > 10000 THEN 'MEDIO' ELSE 'BAIXO' END AS faixa_valor,
           {HOUR} AS hora_transacao, {DOW} AS dia_semana
    FROM transacoes"""))
def _(spark, d):
    return medallion.silver_transacoes(_staged_transactions(spark, d))


@query("silver_accounts", sql(
    "id:i cliente_id:i tipo_conta:s saldo:r limite_credito:r limite_utilizado:r status:s data_abertura:t data_atualizacao:t",
    """
    SELECT id, cliente_id, tipo_conta, saldo, limite AS limite_credito, least(saldo, limite) AS limite_utilizado, status,
           data_abertura, data_atualizacao FROM contas WHERE status = 'ATIVA'"""))
def _(spark, d):
    return medallion.silver_contas(_staged_accounts(spark, d))


SILVER_CUSTOMERS = """
    SELECT c.id AS cliente_id, c.nome, c.data_nascimento, c.status, coalesce(a.n, 0) AS total_contas,
           coalesce(a.s, 0) AS saldo_total, a.ultima AS ultima_conta_abertura
    FROM clientes c LEFT JOIN (SELECT cliente_id, count(*) AS n, sum(saldo) AS s, max(data_abertura) AS ultima
                               FROM contas GROUP BY cliente_id) a ON a.cliente_id = c.id"""


@query("silver_customers", sql(
    "cliente_id:i nome:s data_nascimento:d status:s total_contas:i saldo_total:r ultima_conta_abertura:t",
    SILVER_CUSTOMERS))
def _(spark, d):
    return _silver_customers(spark, d)


@query("gold_accounts", sql(
    "data:t tipo_conta:s status:s total_contas:i saldo_total:r saldo_medio:r limite_total:r limite_utilizado_total:r", """
    SELECT date_trunc('day', data_atualizacao) AS data, tipo_conta, status, count(*) AS total_contas,
           sum(saldo) AS saldo_total, avg(saldo) AS saldo_medio, sum(limite) AS limite_total,
           sum(least(saldo, limite)) AS limite_utilizado_total
    FROM contas GROUP BY ALL"""))
def _(spark, d):
    return medallion.gold_contas_resumo(_staged_accounts(spark, d))


@query("gold_daily", sql(
    "data:t tipo_transacao:s total_transacoes:i volume_total:r ticket_medio:r contas_unicas:i", """
    SELECT date_trunc('day', data_transacao) AS data, tipo_transacao, count(*) AS total_transacoes,
           sum(valor) AS volume_total, avg(valor) AS ticket_medio, count(DISTINCT conta_id) AS contas_unicas
    FROM transacoes WHERE status = 'AUTORIZADA' GROUP BY ALL"""))
def _(spark, d):
    silver = medallion.silver_transacoes(_staged_transactions(spark, d))
    return medallion.gold_transacoes_diarias(silver, "AUTORIZADA")


VOLUME = f"""
    SELECT o.cliente_id, count(*) AS total_transacoes_30d, sum(t.valor) AS volume_30d, avg(t.valor) AS ticket_medio_30d,
           max(t.valor) AS maior_transacao_30d, count(DISTINCT t.tipo_transacao) AS tipos_utilizados
    FROM transacoes t JOIN contas o ON o.id = t.conta_id
    WHERE t.data_transacao >= DATE '{BANK_DAY}' - 30 GROUP BY o.cliente_id"""


@query("customer_volume", sql(
    "cliente_id:i total_transacoes_30d:i volume_30d:r ticket_medio_30d:r maior_transacao_30d:r tipos_utilizados:i", VOLUME))
def _(spark, d):
    silver = medallion.silver_transacoes(_staged_transactions(spark, d))
    return medallion.customer_volume(silver, _staged_accounts(spark, d), BANK_DAY)


@query("gold_customer_risk", sql(
    "cliente_id:i nome:s data_nascimento:d status:s total_contas:i saldo_total:r ultima_conta_abertura:t "
    "total_transacoes_30d:i volume_30d:r ticket_medio_30d:r maior_transacao_30d:r tipos_utilizados:i "
    "nivel_risco_volume:s", f"""
    SELECT s.*, coalesce(v.total_transacoes_30d, 0) AS total_transacoes_30d, coalesce(v.volume_30d, 0) AS volume_30d,
           v.ticket_medio_30d, v.maior_transacao_30d, v.tipos_utilizados,
           CASE WHEN coalesce(v.volume_30d, 0) > 100000 THEN 'ALTO'
                WHEN coalesce(v.volume_30d, 0) > 50000 THEN 'MEDIO' ELSE 'BAIXO' END AS nivel_risco_volume
    FROM ({SILVER_CUSTOMERS}) s LEFT JOIN ({VOLUME}) v ON v.cliente_id = s.cliente_id"""))
def _(spark, d):
    silver = medallion.silver_transacoes(_staged_transactions(spark, d))
    return medallion.gold_clientes_risco(_silver_customers(spark, d), silver, _staged_accounts(spark, d), BANK_DAY)


# --- metrics --------------------------------------------------------------------------------

COMMON = """count(*) AS total_transacoes, sum(valor) AS valor_total, avg(valor) AS valor_medio,
    avg(score_risco) AS score_risco_medio, count(*) FILTER (aprovada) AS transacoes_aprovadas"""


@query("metrics_hourly", sql(
    "hora:i tipo_transacao:s status:s total_transacoes:i valor_total:r valor_medio:r score_risco_medio:r "
    "transacoes_aprovadas:i transacoes_valor_alto:i taxa_aprovacao:r", f"""
    SELECT {HOUR} AS hora, tipo_transacao, status, {COMMON}, count(*) FILTER (valor > 1000) AS transacoes_valor_alto,
           count(*) FILTER (aprovada) * 1.0e0 / count(*) AS taxa_aprovacao
    FROM eventos GROUP BY ALL"""))
def _(spark, d):
    return metrics.metrics_hourly(enrich.enrich_transactions(eventos(spark, d)))


MORE_COLUMNS = "maior_tempo:i cidades:i"
MORE = "max(tempo_processamento_ms) AS maior_tempo, count(DISTINCT cidade) AS cidades"


def _extras() -> Extras:
    """Expressions need a session."""
    return Extras({"maior_tempo": F.max("tempo_processamento_ms"), "cidades": F.count_distinct("cidade")}, F.col("canal") == "WEB")


@query("extras_hourly", sql(
    f"hora:i tipo_transacao:s status:s total_transacoes:i valor_total:r valor_medio:r transacoes_valor_alto:i {MORE_COLUMNS}", f"""
    SELECT {HOUR} AS hora, tipo_transacao, status, {COMMON}, count(*) FILTER (valor > 1000) AS transacoes_valor_alto, {MORE}
    FROM eventos WHERE canal = 'WEB' GROUP BY ALL"""))
def _(spark, d):
    found = metrics.metrics_hourly(enrich.enrich_transactions(eventos(spark, d)), _extras())
    return found.drop("score_risco_medio", "transacoes_aprovadas", "taxa_aprovacao")


@query("extras_location", sql(
    f"estado:s cidade:s tipo_transacao:s total_transacoes:i valor_total:r {MORE_COLUMNS}", f"""
    SELECT estado, cidade, tipo_transacao, {COMMON}, {MORE} FROM transacoes WHERE canal = 'WEB' GROUP BY estado, cidade, tipo_transacao"""))
def _(spark, d):
    return metrics.metrics_location(transacoes(spark, d), _extras()).drop("score_risco_medio", "transacoes_aprovadas")


@query("extras_account", sql(
    f"conta_id:i total_transacoes:i valor_total:r valor_medio:r {MORE_COLUMNS}", f"""
    SELECT conta_id, {COMMON}, {MORE} FROM eventos WHERE canal = 'WEB' GROUP BY conta_id"""))
def _(spark, d):
    found = metrics.metrics_account(enrich.enrich_transactions(eventos(spark, d)), _extras())
    return found.select("conta_id", "total_transacoes", "valor_total", "valor_medio", "maior_tempo", "cidades")


@query("extras_windows", sql(
    f"conta_id:i data_ref:t janela_dias:i total_transacoes:i valor_total:r {MORE_COLUMNS}", f"""
    SELECT conta_id, data_ref, janela_dias, total_transacoes, valor_total, maior_tempo, cidades FROM (
        SELECT conta_id, date_trunc('day', data_transacao) AS data_ref, {COMMON}, {MORE} FROM transacoes
        WHERE canal = 'WEB' GROUP BY conta_id, date_trunc('day', data_transacao)) t
    JOIN (SELECT unnest([7, 30]) AS janela_dias) w ON data_ref >= DATE '{BANK_DAY}' - to_days(CAST(janela_dias AS INT))"""))
def _(spark, d):
    found = metrics.aggregate_windows(transacoes(spark, d), (7, 30), BANK_DAY, _extras())
    return found.select("conta_id", "data_ref", "janela_dias", "total_transacoes", "valor_total", "maior_tempo", "cidades")


@query("extras_global", sql(
    f"data_ref:t total_transacoes:i valor_total:r contas_ativas:i {MORE_COLUMNS}", f"""
    SELECT date_trunc('day', data_transacao) AS data_ref, {COMMON}, count(DISTINCT conta_id) AS contas_ativas, {MORE}
    FROM transacoes WHERE canal = 'WEB' GROUP BY date_trunc('day', data_transacao)"""))
def _(spark, d):
    return metrics.aggregate_global(transacoes(spark, d), _extras()).drop("valor_medio", "score_risco_medio")


@query("metrics_location", sql(
    "estado:s cidade:s tipo_transacao:s total_transacoes:i valor_total:r score_risco_medio:r transacoes_aprovadas:i", f"""
    SELECT estado, cidade, tipo_transacao, {COMMON} FROM transacoes GROUP BY ALL"""))
def _(spark, d):
    return metrics.metrics_location(transacoes(spark, d))


@query("metrics_account", sql(
    "conta_id:i total_transacoes:i valor_total:r valor_medio:r valor_maximo:r valor_minimo:r score_risco_medio:r "
    "transacoes_aprovadas:i transacoes_valor_alto:i taxa_aprovacao:r", f"""
    SELECT conta_id, {COMMON}, max(valor) AS valor_maximo, min(valor) AS valor_minimo,
           count(*) FILTER (valor > 1000) AS transacoes_valor_alto,
           count(*) FILTER (aprovada) * 1.0e0 / count(*) AS taxa_aprovacao
    FROM transacoes GROUP BY conta_id"""))
def _(spark, d):
    return metrics.metrics_account(enrich.enrich_transactions(transacoes(spark, d)))


DAILY_COLUMNS = (
    "conta_id:i data_ref:t total_transacoes:i valor_total:r valor_medio:r valor_maximo:r valor_minimo:r "
    "valor_desvio_padrao:r qtd_transacoes_unicas:i qtd_pix:i qtd_ted:i qtd_doc:i qtd_debito:i qtd_credito:i "
    "qtd_mobile:i qtd_web:i qtd_agencia:i hora_media:r score_risco_medio:r score_risco_maximo:r qtd_valor_alto:i "
    "ticket_medio:r janela_dias:i data_processamento:t"
)


def _daily_sql(days: int) -> str:
    kinds = ", ".join(
        f"count(*) FILTER (tipo_transacao = '{t}') AS qtd_{t.lower()}" for t in ("PIX", "TED", "DOC", "DEBITO", "CREDITO")
    )
    channels = ", ".join(f"count(*) FILTER (canal = '{c}') AS qtd_{c.lower()}" for c in ("MOBILE", "WEB", "AGENCIA"))
    return f"""
    SELECT conta_id, date_trunc('day', data_transacao) AS data_ref, count(*) AS total_transacoes,
           sum(valor) AS valor_total, avg(valor) AS valor_medio, max(valor) AS valor_maximo, min(valor) AS valor_minimo,
           stddev_samp(valor) AS valor_desvio_padrao, count(DISTINCT id) AS qtd_transacoes_unicas, {kinds}, {channels},
           avg({HOUR}) AS hora_media, avg(score_risco) AS score_risco_medio, max(score_risco) AS score_risco_maximo,
           count(*) FILTER (valor > 1000) AS qtd_valor_alto, sum(valor) / count(*) AS ticket_medio, {days} AS janela_dias, TIMESTAMP '{BANK_DAY}' AS data_processamento
    FROM transacoes WHERE data_transacao >= DATE '{BANK_DAY}' - {days} GROUP BY 1, 2"""


for _days in (1, 7, 30):

    @query(f"aggregate_{_days}d", sql(DAILY_COLUMNS, _daily_sql(_days)))
    def _(spark, d, days=_days):
        return metrics.aggregate_window(transacoes(spark, d), days, BANK_DAY)


@query("aggregate_windows", sql(DAILY_COLUMNS, " UNION ALL ".join(_daily_sql(n) for n in (1, 7, 30))))
def _(spark, d):
    return metrics.aggregate_windows(transacoes(spark, d), (1, 7, 30), BANK_DAY)


@query("aggregate_global", sql(
    "data_ref:t total_transacoes:i valor_total:r valor_medio:r contas_ativas:i score_risco_medio:r", """
    SELECT date_trunc('day', data_transacao) AS data_ref, count(*) AS total_transacoes, sum(valor) AS valor_total,
           avg(valor) AS valor_medio, count(DISTINCT conta_id) AS contas_ativas, avg(score_risco) AS score_risco_medio
    FROM transacoes GROUP BY 1"""))
def _(spark, d):
    return metrics.aggregate_global(transacoes(spark, d))


LIVE_FROM = f"TIMESTAMP '{EVENT_DAY}' - INTERVAL 1440 MINUTE"


def _counts_sql(column: str) -> str:
    return f"""(SELECT '{{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}}'
        FROM (SELECT {column} AS k, CAST(sum(n) AS BIGINT) AS n FROM g GROUP BY {column}))"""


@query("live_metrics", sql(
    "transacoes_por_minuto:i valor_total_por_minuto:r taxa_aprovacao:r score_risco_medio:r tempo_resposta_medio:r "
    "transacoes_por_canal:s transacoes_por_tipo:s transacoes_por_estado:s", f"""
    WITH g AS (SELECT canal, tipo_transacao, estado, count(*) AS n, sum(valor) AS v, avg(score_risco) AS s,
                      count(*) FILTER (status = 'AUTORIZADA') AS ok, avg(tempo_processamento_ms) AS ms
               FROM eventos WHERE data_transacao >= {LIVE_FROM} GROUP BY ALL)
    SELECT sum(n) AS transacoes_por_minuto, sum(v) AS valor_total_por_minuto,
           CAST(sum(ok) AS DOUBLE) / sum(n) AS taxa_aprovacao, avg(s) AS score_risco_medio, avg(ms) AS tempo_resposta_medio,
           {_counts_sql('canal')} AS transacoes_por_canal, {_counts_sql('tipo_transacao')} AS transacoes_por_tipo,
           {_counts_sql('estado')} AS transacoes_por_estado
    FROM g"""))
def _(spark, d):
    return metrics.live_transaction_metrics(eventos(spark, d), 1440, EVENT_DAY, "AUTORIZADA")


@query("live_risk_metrics", sql(
    "total_alertas:i score_risco_alertas:r alertas_alto_risco:i alertas_medio_risco:i alertas_baixo_risco:i", f"""
    SELECT count(*) AS total_alertas, avg(score_risco) AS score_risco_alertas,
           count(*) FILTER (nivel_risco = 'ALTO') AS alertas_alto_risco,
           count(*) FILTER (nivel_risco = 'MEDIO') AS alertas_medio_risco,
           count(*) FILTER (nivel_risco = 'BAIXO') AS alertas_baixo_risco
    FROM eventos_risco WHERE data_evento >= TIMESTAMP '{EVENT_DAY}' - INTERVAL 48 HOUR"""))
def _(spark, d):
    return metrics.live_risk_metrics(eventos_risco(spark, d), 48, EVENT_DAY)


@query("live_system_metrics", sql(
    "tempo_resposta_medio:r erros_total:i requests_total:i", f"""
    SELECT avg(event_id % 500) AS tempo_resposta_medio, count(*) FILTER (event_type = 'error') AS erros_total,
           count(*) AS requests_total
    FROM events WHERE ts >= {LIVE_FROM}"""))
def _(spark, d):
    calls = table(spark, d, "events").select(
        F.col("ts").alias("timestamp"), (F.col("event_id") % 500).alias("tempo_resposta_ms"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
    )
    return metrics.live_system_metrics(calls, 1440, EVENT_DAY)


@query("minute_metrics", sql(
    "janela:t total_transacoes:i valor_total:r valor_medio:r contagem_por_tipo:s", """
    WITH g AS (SELECT date_trunc('minute', data_transacao) AS janela, tipo_transacao AS k, count(*) AS n, sum(valor) AS v
               FROM eventos GROUP BY ALL)
    SELECT janela, sum(n) AS total_transacoes, sum(v) AS valor_total, round(sum(v) / sum(n), 2) AS valor_medio,
           '{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}' AS contagem_por_tipo
    FROM g GROUP BY janela"""))
def _(spark, d):
    rows = eventos(spark, d).select(F.col("data_transacao").alias("timestamp"), F.col("tipo_transacao").alias("tipo"), "valor")
    return metrics.minute_metrics(rows)


@query("running_metrics", sql(
    "metric_type:s key:s count:i total_value:r avg_value:r max_value:r min_value:r last_id:i", """
    WITH r AS (SELECT tipo_transacao || '_' || status AS key, id, count(*) OVER w AS n, sum(valor) OVER w AS s,
                      max(valor) OVER w AS hi, min(valor) OVER w AS lo
               FROM eventos WINDOW w AS (PARTITION BY tipo_transacao, status ORDER BY id ROWS UNBOUNDED PRECEDING))
    SELECT 'TRANSACTION_AGGREGATE' AS metric_type, key, n AS count, s AS total_value, s / n AS avg_value,
           greatest(hi, 0) AS max_value, lo AS min_value, id AS last_id
    FROM r WHERE n % 100 = 0"""))
def _(spark, d):
    return metrics.running_metrics(eventos(spark, d))


@query("monthly_statistics", sql(
    "periodo:s tipo_transacao:s total_transacoes:i valor_total:r valor_medio:r transacoes_aprovadas:i "
    "transacoes_rejeitadas:i", """
    SELECT '2024-01' AS periodo, tipo_transacao, count(*) AS total_transacoes, sum(valor) AS valor_total,
           avg(valor) AS valor_medio, count(*) FILTER (status = 'AUTORIZADA') AS transacoes_aprovadas,
           count(*) FILTER (status = 'REJEITADA') AS transacoes_rejeitadas
    FROM eventos WHERE year(data_transacao) = 2024 AND month(data_transacao) = 1 GROUP BY tipo_transacao"""))
def _(spark, d):
    return reports.monthly_statistics(eventos(spark, d), 2024, 1, approved="AUTORIZADA")


@query("monthly_risk", sql(
    "periodo:s tipo_evento:s nivel_risco:s total_eventos:i score_risco_medio:r eventos_resolvidos:i", """
    SELECT '2024-01' AS periodo, tipo_evento, nivel_risco, count(*) AS total_eventos, avg(score_risco) AS score_risco_medio,
           count(*) FILTER (resolvido) AS eventos_resolvidos
    FROM eventos_risco WHERE year(data_evento) = 2024 AND month(data_evento) = 1 GROUP BY ALL"""))
def _(spark, d):
    return reports.monthly_risk_report(eventos_risco(spark, d), 2024, 1)


# --- customer profile -----------------------------------------------------------------------

ROLLUP = """
    SELECT cliente_id, count(*) AS qtd_contas, sum(saldo) AS saldo_total, avg(saldo) AS saldo_medio,
           sum(limite) AS limite_total, count(*) FILTER (status = 'ATIVA') AS contas_ativas,
           count(*) FILTER (tipo_conta = 'CORRENTE') AS tem_conta_corrente,
           count(*) FILTER (tipo_conta = 'POUPANCA') AS tem_poupanca,
           count(*) FILTER (tipo_conta = 'INVESTIMENTO') AS tem_investimento,
           CASE WHEN sum(limite) > 0 THEN sum(saldo) / sum(limite) * 100 ELSE 0 END AS utilizacao_limite_pct
    FROM contas GROUP BY cliente_id"""
ROLLUP_COLUMNS = (
    "qtd_contas:i saldo_total:r saldo_medio:r limite_total:r contas_ativas:i tem_conta_corrente:i tem_poupanca:i "
    "tem_investimento:i utilizacao_limite_pct:p"
)


@query("account_rollup", sql(f"cliente_id:i {ROLLUP_COLUMNS}", ROLLUP), precise=["utilizacao_limite_pct"])
def _(spark, d):
    return profile.account_rollup(contas(spark, d))


def _behaviour_sql(by: str, source: str, ids: str) -> str:
    in30, in90 = (f"t.data_transacao >= DATE '{BANK_DAY}' - {n}" for n in (30, 90))
    return f"""
    SELECT {by}, count(*) FILTER ({in30}) AS transacoes_30d, coalesce(sum(t.valor) FILTER ({in30}), 0) AS volume_30d,
           avg(t.valor) FILTER ({in30}) AS ticket_medio_30d, {ids} AS qtd_transacoes_30d,
           count(*) FILTER ({in90}) AS transacoes_90d, coalesce(sum(t.valor) FILTER ({in90}), 0) AS volume_90d,
           avg(t.valor) FILTER ({in90}) AS ticket_medio_90d, avg({HOUR}) AS hora_media_transacoes,
           avg({DOW} + 1) AS dia_semana_medio, count(*) FILTER ({in30} AND t.tipo_transacao = 'PIX') AS pix_30d,
           avg(t.score_risco) AS score_risco_medio_transacoes, max(t.score_risco) AS score_risco_max_transacoes,
           count(DISTINCT t.tipo_transacao) AS qtd_tipos_transacao, count(DISTINCT t.canal) AS qtd_canais_utilizados,
           max(t.data_transacao) AS ultima_transacao, count(*) FILTER ({in90}) / 13.0e0 AS frequencia_semanal,
           DATE '{BANK_DAY}' - CAST(max(t.data_transacao) AS DATE) AS dias_desde_ultima_transacao
    FROM {source} GROUP BY {by}"""


BEHAVIOUR_COLUMNS = (
    "transacoes_30d:i volume_30d:r ticket_medio_30d:r qtd_transacoes_30d:i transacoes_90d:i volume_90d:r "
    "ticket_medio_90d:r hora_media_transacoes:r dia_semana_medio:r pix_30d:i score_risco_medio_transacoes:r "
    "score_risco_max_transacoes:r qtd_tipos_transacao:i qtd_canais_utilizados:i ultima_transacao:t "
    "frequencia_semanal:r dias_desde_ultima_transacao:i"
)
IDS_30D = f"count(DISTINCT t.id) FILTER (t.data_transacao >= DATE '{BANK_DAY}' - 30)"


@query("account_behaviour", sql(f"conta_id:i {BEHAVIOUR_COLUMNS}", _behaviour_sql("conta_id", "transacoes t", IDS_30D)))
def _(spark, d):
    return profile.account_behaviour(transacoes(spark, d), BANK_DAY)


CUSTOMER_BEHAVIOUR = _behaviour_sql("o.cliente_id", "transacoes t JOIN contas o ON o.id = t.conta_id", IDS_30D)


@query("customer_profile", sql(
    f"id:i nome:s idade:i tempo_como_cliente_dias:i score_risco:r status:s data_cadastro:d {ROLLUP_COLUMNS} "
    f"{BEHAVIOUR_COLUMNS} classe_risco:s perfil_ativo:b data_processamento:t", f"""
    SELECT c.id, c.nome, trunc((DATE '{BANK_DAY}' - c.data_nascimento) / 365.25e0) AS idade,
           DATE '{BANK_DAY}' - c.created_at AS tempo_como_cliente_dias, c.score_risco, c.status,
           c.created_at AS data_cadastro, a.* EXCLUDE (cliente_id), b.* EXCLUDE (cliente_id),
           CASE WHEN c.score_risco >= 800 THEN 'A' WHEN c.score_risco >= 600 THEN 'B'
                WHEN c.score_risco >= 400 THEN 'C' ELSE 'D' END AS classe_risco,
           coalesce(b.dias_desde_ultima_transacao <= 30, false) AS perfil_ativo, TIMESTAMP '{BANK_DAY}' AS data_processamento
    FROM clientes c LEFT JOIN ({ROLLUP}) a ON a.cliente_id = c.id
    LEFT JOIN ({CUSTOMER_BEHAVIOUR}) b ON b.cliente_id = c.id"""), precise=["utilizacao_limite_pct"])
def _(spark, d):
    return profile.customer_profile(clientes(spark, d), contas(spark, d), transacoes(spark, d), BANK_DAY)


# --- risk score -----------------------------------------------------------------------------

DAYS = "count(DISTINCT CAST(data_transacao AS DATE))"
SCORE_BEHAVIOUR = f"""
    SELECT conta_id, CAST(trunc(least({DAYS} / 90.0e0, 1.0e0) * 60
        + (1 - count(*) FILTER ({NIGHT}) * 1.0e0 / count(*)) * 20
        + (1 - count(*) FILTER (valor > 10000) * 1.0e0 / count(*)) * 20) AS INT) AS score_comportamento
    FROM transacoes GROUP BY conta_id"""
SCORE_ACTIVITY = f"""
    SELECT conta_id, least(CAST(trunc({DAYS} / 90.0e0 * 50 + count(DISTINCT tipo_transacao) * 10
        + count(DISTINCT canal) * 10) AS INT), 100) AS score_atividade
    FROM transacoes GROUP BY conta_id"""
SCORE_CONCENTRATION = """
    SELECT conta_id, CASE WHEN count(DISTINCT cidade) <= 2 THEN 90 WHEN count(DISTINCT cidade) <= 5 THEN 70
                          WHEN count(DISTINCT cidade) <= 10 THEN 50 ELSE 30 END AS score_concentracao
    FROM transacoes GROUP BY conta_id"""
SCORE_CREDIT = """
    SELECT cliente_id, CASE WHEN u < 0.3e0 THEN 90 WHEN u < 0.5e0 THEN 75 WHEN u < 0.8e0 THEN 50 ELSE 25 END AS score_credito
    FROM (SELECT cliente_id, CASE WHEN sum(limite) > 0 THEN sum(saldo) / sum(limite) ELSE 0 END AS u
          FROM contas GROUP BY cliente_id)"""
SCORE_DIVERSITY = """
    SELECT cliente_id, least(count(DISTINCT tipo_conta) * 25, 100) AS score_diversidade FROM contas GROUP BY cliente_id"""


@query("score_behaviour", sql("conta_id:i score_comportamento:i", SCORE_BEHAVIOUR))
def _(spark, d):
    return risk.score_behaviour(transacoes(spark, d))


@query("score_activity", sql("conta_id:i score_atividade:i", SCORE_ACTIVITY))
def _(spark, d):
    return risk.score_activity(transacoes(spark, d))


@query("score_concentration", sql("conta_id:i score_concentracao:i", SCORE_CONCENTRATION))
def _(spark, d):
    return risk.score_concentration(transacoes(spark, d))


@query("score_credit", sql("cliente_id:i score_credito:i", SCORE_CREDIT))
def _(spark, d):
    return risk.score_credit(contas(spark, d))


@query("score_diversity", sql("cliente_id:i score_diversidade:i", SCORE_DIVERSITY))
def _(spark, d):
    return risk.score_diversity(contas(spark, d))


CUSTOMER_SCORES = f"""
    SELECT o.cliente_id, avg(b.score_comportamento) AS score_comportamento, avg(a.score_atividade) AS score_atividade,
           avg(k.score_concentracao) AS score_concentracao
    FROM (SELECT DISTINCT id, cliente_id FROM contas) o
    LEFT JOIN ({SCORE_BEHAVIOUR}) b ON b.conta_id = o.id LEFT JOIN ({SCORE_ACTIVITY}) a ON a.conta_id = o.id
    LEFT JOIN ({SCORE_CONCENTRATION}) k ON k.conta_id = o.id GROUP BY o.cliente_id"""


@query("customer_account_scores", sql(
    "cliente_id:i score_comportamento:r score_atividade:r score_concentracao:r", CUSTOMER_SCORES))
def _(spark, d):
    return risk.customer_account_scores(contas(spark, d), transacoes(spark, d))


def _risk_sql(scale: int) -> str:
    parts = ", ".join(
        f"coalesce({c}, 50) AS {c}"
        for c in ("score_risco", "score_comportamento", "score_atividade", "score_concentracao", "score_credito",
                  "score_diversidade")
    )
    return f"""
    WITH j AS (SELECT c.id, c.nome, {parts} FROM clientes c LEFT JOIN ({CUSTOMER_SCORES}) s ON s.cliente_id = c.id
               LEFT JOIN ({SCORE_CREDIT}) k ON k.cliente_id = c.id LEFT JOIN ({SCORE_DIVERSITY}) v ON v.cliente_id = c.id),
         f AS (SELECT *, CAST(trunc((score_comportamento * 0.35e0 + score_credito * 0.25e0 + score_atividade * 0.20e0
               + score_concentracao * 0.10e0 + score_diversidade * 0.10e0) * {scale}) AS INT) AS score_risco_calculado FROM j)
    SELECT *, CASE WHEN score_risco_calculado >= 750 THEN 'BAIXO' WHEN score_risco_calculado >= 500 THEN 'MEDIO'
                   WHEN score_risco_calculado >= 250 THEN 'ALTO' ELSE 'MUITO_ALTO' END AS nivel_risco,
           DATE '{BANK_DAY}' AS data_scoring, TIMESTAMP '{BANK_DAY}' AS data_processamento FROM f"""


RISK_COLUMNS = (
    "id:i nome:s score_risco:r score_comportamento:r score_atividade:r score_concentracao:r score_credito:i "
    "score_diversidade:i score_risco_calculado:i nivel_risco:s data_scoring:d data_processamento:t"
)


@query("risk_score", sql(RISK_COLUMNS, _risk_sql(1)))
def risk_score(spark, d):
    return risk.risk_score(clientes(spark, d), contas(spark, d), transacoes(spark, d), BANK_DAY)


@query("risk_score_scaled", sql(RISK_COLUMNS, _risk_sql(10)))
def _(spark, d):
    return risk.risk_score(clientes(spark, d), contas(spark, d), transacoes(spark, d), BANK_DAY, scale=10)


@query("score_write_back", sql(
    "cliente_id:i score_risco_calculado:i",
    f"SELECT id AS cliente_id, score_risco_calculado FROM ({_risk_sql(1)})"))
def _(spark, d):
    from ..sinks import score_write_back

    return score_write_back(risk_score(spark, d))
