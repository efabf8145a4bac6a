"""Queries over event-time windows, alert rules and feature sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.extras import Extras
from ..operators import alerts, features, windows
from ..operators.latest import keep_latest
from ..sources.testdata import clientes, contas, eventos, transacoes
from .registry import BANK_DAY, EVENT_DAY, query, sql

HOUR = "extract(hour FROM data_transacao)"
DOW = "extract(dow FROM data_transacao)"
NIGHT = f"({HOUR} < 6 OR {HOUR} > 22)"
WEEKEND = f"({DOW} IN (0, 6))"


def _money(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(19,4)) AS VARCHAR)"


def _stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%g')"


def _tumble(size: str) -> str:
    return f"time_bucket(INTERVAL '{size}', data_transacao, TIMESTAMP '1970-01-01')"


def _hops(size: str, slide: str, panes: int, where: str = "true") -> str:
    """Every row once per sliding window it belongs to."""
    return f"""
    SELECT *, start AS window_start, start + INTERVAL '{size}' AS window_end FROM (
        SELECT *, {_tumble(slide)} - i * INTERVAL '{slide}' AS start
        FROM eventos, unnest(generate_series(0, {panes - 1})) AS g(i) WHERE {where})"""


# --- windows --------------------------------------------------------------------------------


@query("window_1s", sql(
    "window_start:t window_end:t tipo_transacao:s canal:s status:s total_transacoes:i valor_total:r valor_medio:r "
    "score_risco_medio:r taxa_aprovacao:r tempo_resposta_medio:r", f"""
    SELECT {_tumble('1 second')} AS window_start, {_tumble('1 second')} + INTERVAL 1 SECOND AS window_end,
           tipo_transacao, canal, status, count(*) AS total_transacoes, sum(valor) AS valor_total,
           avg(valor) AS valor_medio, avg(score_risco) AS score_risco_medio,
           count(*) FILTER (aprovada) * 1.0e0 / count(*) AS taxa_aprovacao, avg(tempo_processamento_ms) AS tempo_resposta_medio
    FROM eventos GROUP BY ALL"""))
def _(spark, d):
    return windows.metrics_per_second(eventos(spark, d))


@query("window_1h", sql(
    "window_start:t window_end:t tipo_transacao:s status:s total_transacoes:i valor_total:r valor_medio:r "
    "score_risco_medio:r", f"""
    SELECT {_tumble('1 hour')} AS window_start, {_tumble('1 hour')} + INTERVAL 1 HOUR AS window_end, tipo_transacao, status,
           count(*) AS total_transacoes, sum(valor) AS valor_total, avg(valor) AS valor_medio,
           avg(score_risco) AS score_risco_medio
    FROM eventos GROUP BY ALL"""))
def _(spark, d):
    return windows.metrics_per_hour(eventos(spark, d))


SLIDING_COLUMNS = "window_start:t window_end:t metrica_tipo:s valor:r dimensao:s dimensao_valor:s"
HOPS_10S = _hops("5 minutes", "10 seconds", 30)


@query("sliding_volume", sql(SLIDING_COLUMNS, f"""
    SELECT window_start, window_end, 'VOLUME_TRANSACOES' AS metrica_tipo, sum(valor) AS valor,
           'tipo_transacao' AS dimensao, tipo_transacao AS dimensao_valor
    FROM ({HOPS_10S}) GROUP BY window_start, window_end, tipo_transacao"""))
def _(spark, d):
    return windows.sliding_volume(eventos(spark, d))


@query("sliding_channel", sql(SLIDING_COLUMNS, f"""
    SELECT window_start, window_end, 'TRANSACOES_POR_CANAL' AS metrica_tipo, count(*) AS valor,
           'canal' AS dimensao, canal AS dimensao_valor
    FROM ({HOPS_10S}) GROUP BY window_start, window_end, canal"""))
def _(spark, d):
    return windows.sliding_channel(eventos(spark, d))


@query("sliding_approval", sql(SLIDING_COLUMNS, f"""
    SELECT window_start, window_end, 'TAXA_APROVACAO' AS metrica_tipo,
           count(*) FILTER (aprovada) * 1.0e0 / count(*) AS valor, 'global' AS dimensao, 'GLOBAL' AS dimensao_valor
    FROM ({HOPS_10S}) GROUP BY window_start, window_end"""))
def _(spark, d):
    return windows.sliding_approval(eventos(spark, d))


# --- alerts ---------------------------------------------------------------------------------

FRAUD_COLUMNS = (
    "alerta_id:s conta_id:i transacao_id:i tipo_fraude:s score_fraude:r nivel_risco:s descricao:s regras_acionadas:s "
    "valor_transacao:r canal:s cidade:s estado:s timestamp_alerta:t recomendacao:s"
)
PIX_COLUMNS = (
    "alerta_id:s conta_id:i transacao_id:i tipo_alerta:s valor_transacao:r descricao:s score_risco:r "
    "timestamp_alerta:t recomendacao:s"
)


R1_SQL = f"""
    SELECT 'ALT-R1-' || id AS alerta_id, conta_id, id AS transacao_id, 'ALTO_VALOR_NOTURNO' AS tipo_fraude,
           0.85 AS score_fraude, 'ALTO' AS nivel_risco,
           'Transação de alto valor (R$ ' || {_money('valor')} || ') em horário noturno' AS descricao,
           'REGRA_1_ALTO_VALOR_NOTURNO' AS regras_acionadas, valor AS valor_transacao, canal, cidade, estado,
           data_transacao AS timestamp_alerta, 'BLOQUEAR_E_VERIFICAR' AS recomendacao
    FROM eventos WHERE valor > 10000 AND {NIGHT}"""


@query("alert_r1", sql(FRAUD_COLUMNS, R1_SQL))
def _(spark, d):
    return alerts.high_value_at_night(eventos(spark, d))


def _long(size: str) -> str:
    return {"1 minute": "1 minuto", "5 minutes": "5 minutos", "1 hour": "1 hora", "12 hours": "12 horas"}[size]


def _short(size: str) -> str:
    return {"5 minutes": "5min", "1 hour": "1h", "12 hours": "12h"}[size]


def _rapid(size: str, minimum: int) -> str:
    return f"""
    SELECT 'ALT-R2-' || conta_id || '-' || {_stamp('w')} AS alerta_id, conta_id, 0 AS transacao_id,
           'TRANSACOES_RAPIDAS' AS tipo_fraude, CASE WHEN n >= 10 THEN 0.95 WHEN n >= 5 THEN 0.80 ELSE 0.60 END AS score_fraude,
           CASE WHEN n >= 10 THEN 'CRITICO' WHEN n >= 5 THEN 'ALTO' ELSE 'MEDIO' END AS nivel_risco,
           n || ' transações em {_long(size)} da conta' AS descricao, 'REGRA_2_TRANSACOES_RAPIDAS' AS regras_acionadas,
           s AS valor_transacao, '' AS canal, '' AS cidade, '' AS estado, w + INTERVAL '{size}' AS timestamp_alerta,
           'REVISAO_MANUAL' AS recomendacao
    FROM (SELECT conta_id, {_tumble(size)} AS w, count(*) AS n, sum(valor) AS s FROM eventos WHERE aprovada
          GROUP BY 1, 2 HAVING count(*) >= {minimum})"""


@query("alert_r2", sql(FRAUD_COLUMNS, _rapid("1 minute", 3)))
def _(spark, d):
    return alerts.rapid_transactions(eventos(spark, d))


@query("alert_r2_hourly", sql(FRAUD_COLUMNS, _rapid("1 hour", 2)))
def _(spark, d):
    return alerts.rapid_transactions(eventos(spark, d), "1 hour", 2)


def _build_up(size: str, slide: str, panes: int, limit: int) -> str:
    return f"""
    SELECT 'ALT-R3-' || conta_id || '-' || {_stamp('window_end')} AS alerta_id, conta_id, 0 AS transacao_id,
           'ACUMULO_VALOR' AS tipo_fraude, CASE WHEN s > 50000 THEN 0.98 WHEN s > 30000 THEN 0.90 ELSE 0.75 END AS score_fraude,
           CASE WHEN s > 50000 THEN 'CRITICO' WHEN s > 30000 THEN 'ALTO' ELSE 'MEDIO' END AS nivel_risco,
           'Acumulo de R$ ' || {_money('s')} || ' em {_long(size)} da conta' AS descricao,
           'REGRA_3_ACUMULO_VALOR' AS regras_acionadas, s AS valor_transacao, '' AS canal, '' AS cidade, '' AS estado,
           window_end AS timestamp_alerta, 'BLOQUEAR_E_VERIFICAR' AS recomendacao
    FROM (SELECT conta_id, window_end, sum(valor) AS s FROM ({_hops(size, slide, panes, 'aprovada')})
          GROUP BY 1, 2 HAVING sum(valor) > {limit})"""


@query("alert_r3", sql(FRAUD_COLUMNS, _build_up("5 minutes", "1 minute", 5, 20000)))
def _(spark, d):
    return alerts.value_build_up(eventos(spark, d))


@query("alert_r3_hourly", sql(FRAUD_COLUMNS, _build_up("1 hour", "5 minutes", 12, 15000)))
def _(spark, d):
    return alerts.value_build_up(eventos(spark, d), "1 hour", "5 minutes", 15000)


R4_COLUMNS = (
    "alerta_id:s conta_id:i transacao_id:i tipo_fraude:s cidade_anterior:s cidade:s timestamp_anterior:t timestamp_alerta:t"
)
R4_SQL = """
    SELECT 'ALT-R4-' || id AS alerta_id, conta_id, id AS transacao_id, 'DESVIO_GEOGRAFICO' AS tipo_fraude,
           p AS cidade_anterior, cidade, q AS timestamp_anterior, data_transacao AS timestamp_alerta
    FROM (SELECT *, lag(cidade) OVER w AS p, lag(data_transacao) OVER w AS q FROM eventos
          WINDOW w AS (PARTITION BY conta_id ORDER BY data_transacao, id)) WHERE p <> cidade"""


@query("alert_r4", sql(
    R4_COLUMNS, R4_SQL))
def _(spark, d):
    return alerts.location_change(eventos(spark, d))


def _pix_high(limit: int) -> str:
    return f"""
    SELECT 'PIX-CEP1-' || id AS alerta_id, conta_id, id AS transacao_id, 'PIX_ALTO_VALOR' AS tipo_alerta,
           valor AS valor_transacao, 'PIX de R$ ' || {_money('valor')} AS descricao, score_risco,
           data_transacao AS timestamp_alerta, 'VERIFICACAO_MANUAL_OBRIGATORIA' AS recomendacao
    FROM eventos WHERE tipo_transacao = 'PIX' AND valor > {limit}"""


@query("alert_r5", sql(PIX_COLUMNS, _pix_high(50000)))
def _(spark, d):
    return alerts.pix_high_value(eventos(spark, d))


@query("alert_r5_lower", sql(PIX_COLUMNS, _pix_high(20000)))
def _(spark, d):
    return alerts.pix_high_value(eventos(spark, d), 20000)


def _sweep(size: str, minimum: int) -> str:
    return f"""
    SELECT 'PIX-CEP2-' || conta_id || '-' || {_stamp(f"w + INTERVAL '{size}'")} AS alerta_id, conta_id, 0 AS transacao_id,
           'PIX_VARREDURA' AS tipo_alerta, s AS valor_transacao, n || ' PIX em {_short(size)}' AS descricao, 0.85 AS score_risco,
           w + INTERVAL '{size}' AS timestamp_alerta, 'BLOQUEAR_PROXIMOS_PIX' AS recomendacao
    FROM (SELECT conta_id, {_tumble(size)} AS w, count(*) AS n, sum(valor) AS s FROM eventos
          WHERE tipo_transacao = 'PIX' AND status = 'AUTORIZADA' GROUP BY 1, 2 HAVING count(*) >= {minimum})"""


@query("alert_r6", sql(PIX_COLUMNS, _sweep("5 minutes", 5)))
def _(spark, d):
    return alerts.pix_sweep(eventos(spark, d))


@query("alert_r6_hourly", sql(PIX_COLUMNS, _sweep("1 hour", 2)))
def _(spark, d):
    return alerts.pix_sweep(eventos(spark, d), "1 hour", 2)


R7_SQL = f"""
    SELECT 'PIX-CEP3-' || id AS alerta_id, conta_id, id AS transacao_id, 'PIX_HORARIO_ANOMALO' AS tipo_alerta,
           valor AS valor_transacao, 'PIX R$ ' || {_money('valor')} || ' as ' || {HOUR} || 'h' AS descricao,
           greatest(score_risco, 0.7e0) AS score_risco, data_transacao AS timestamp_alerta, 'NOTIFICAR_CLIENTE' AS recomendacao
    FROM eventos WHERE tipo_transacao = 'PIX' AND valor > 5000 AND {NIGHT}"""


@query("alert_r7", sql(PIX_COLUMNS, R7_SQL))
def _(spark, d):
    return alerts.pix_odd_hours(eventos(spark, d))


def _cities(size: str, slide: str, panes: int, minimum: int) -> str:
    hops = _hops(size, slide, panes, "tipo_transacao = 'PIX'")
    return f"""
    SELECT 'PIX-CEP4-' || conta_id || '-' || {_stamp('window_end')} AS alerta_id, conta_id, 0 AS transacao_id,
           'PIX_MULTI_CIDADE' AS tipo_alerta, s AS valor_transacao, n || ' cidades em {_short(size)}' AS descricao, 0.92 AS score_risco,
           window_end AS timestamp_alerta, 'BLOQUEAR_CONTA' AS recomendacao
    FROM (SELECT conta_id, window_end, count(DISTINCT cidade) AS n, sum(valor) AS s FROM ({hops})
          GROUP BY 1, 2 HAVING count(DISTINCT cidade) >= {minimum})"""


@query("alert_r8", sql(PIX_COLUMNS, _cities("1 hour", "5 minutes", 12, 3)))
def _(spark, d):
    return alerts.pix_many_cities(eventos(spark, d))


@query("alert_r8_12h", sql(PIX_COLUMNS, _cities("12 hours", "1 hour", 12, 2)))
def _(spark, d):
    return alerts.pix_many_cities(eventos(spark, d), "12 hours", "1 hour", 2)


RISK_COLUMNS = (
    "alert_id:s account_id:i transaction_id:i risk_score:r alert_type:s description:s timestamp:t recommended_action:s"
)
POINTS = f"""least(CASE WHEN valor > 5000 THEN 0.3e0 ELSE 0 END + CASE WHEN {NIGHT} THEN 0.2e0 ELSE 0 END
    + CASE WHEN {WEEKEND} THEN 0.1e0 ELSE 0 END + CASE WHEN canal = 'MOBILE' THEN 0.1e0 ELSE 0 END, 1.0e0)"""
NOW = f"TIMESTAMP '{EVENT_DAY}'"


def _high_risk(threshold: float) -> str:
    return f"""
    SELECT 'risk_' || conta_id || '_' || CAST(epoch({NOW}) AS BIGINT) AS alert_id, conta_id AS account_id,
           id AS transaction_id, p AS risk_score, 'HIGH_RISK_TRANSACTION' AS alert_type,
           'Transação de alto risco detectada: R$ ' || {_money('valor')} AS description, {NOW} AS timestamp,
           'REVIEW_MANUAL' AS recommended_action
    FROM (SELECT *, {POINTS} AS p FROM eventos) WHERE p > {threshold}e0"""


PATTERN = f"""
    SELECT 'pattern_' || conta_id || '_' || CAST(epoch({NOW}) AS BIGINT) AS alert_id, conta_id AS account_id,
           id AS transaction_id, NULL AS risk_score, 'SUSPICIOUS_PATTERN' AS alert_type,
           'Padrão suspeito detectado na transação' AS description, {NOW} AS timestamp, 'INVESTIGATE' AS recommended_action
    FROM eventos WHERE {NIGHT} OR (valor % 1000 = 0 AND valor > 10000) OR ({WEEKEND} AND valor > 5000)"""


@query("alert_r9", sql(RISK_COLUMNS, _high_risk(0.7)))
def _(spark, d):
    return alerts.high_risk(eventos(spark, d), as_of=EVENT_DAY)


@query("alert_r9_lower", sql(RISK_COLUMNS, _high_risk(0.45)))
def _(spark, d):
    return alerts.high_risk(eventos(spark, d), 0.45, EVENT_DAY)


@query("alert_r10", sql(RISK_COLUMNS, PATTERN))
def _(spark, d):
    return alerts.suspicious_pattern(eventos(spark, d), EVENT_DAY)


@query("risk_alerts", sql(RISK_COLUMNS, f"{_high_risk(0.45)} UNION ALL {PATTERN}"))
def _(spark, d):
    return alerts.risk_alerts(eventos(spark, d), 0.45, EVENT_DAY)


# --- rules and aggregates with a condition and measures of the caller ------------------------

WEB = "WITH web AS (SELECT * FROM eventos WHERE canal = 'WEB' OR valor > 9000)"


def _per_row(rule: str, transaction: str = "transacao_id") -> str:
    """The rule over the rows the condition leaves, with a measure of each transaction."""
    return f"""{WEB} SELECT r.*, e.valor * 2 + e.tempo_processamento_ms AS peso
    FROM ({rule.replace("FROM eventos", "FROM web")}) r JOIN eventos e ON e.id = r.{transaction}"""


def _per_window(rule: str, size: str, rows: str, measure: str) -> str:
    """The same with a measure of the window's rows."""
    return f"""{WEB} SELECT r.*, (
        SELECT {measure} FROM web w WHERE w.conta_id = r.conta_id AND {rows} AND w.data_transacao < r.timestamp_alerta
        AND w.data_transacao >= r.timestamp_alerta - INTERVAL '{size}') AS peso
    FROM ({rule.replace("FROM eventos", "FROM web")}) r"""


def _extras(measure: str) -> Extras:
    """Per transaction, per group and per sum, as the rule takes it; expressions need a session."""
    time = F.col("tempo_processamento_ms")
    peso = {"row": F.col("valor") * 2 + time, "group": F.max(time), "sum": time}[measure]
    return Extras({"peso": peso}, (F.col("canal") == "WEB") | (F.col("valor") > 9000))


@query("extras_r1", sql(f"{FRAUD_COLUMNS} peso:r", _per_row(R1_SQL)))
def _(spark, d):
    return alerts.high_value_at_night(eventos(spark, d), extras=_extras("row"))


@query("extras_r2", sql(f"{FRAUD_COLUMNS} peso:i", _per_window(_rapid("1 hour", 2), "1 hour", "w.aprovada", "max(tempo_processamento_ms)")))
def _(spark, d):
    return alerts.rapid_transactions(eventos(spark, d), "1 hour", 2, _extras("group"))


@query("extras_r3", sql(f"{FRAUD_COLUMNS} peso:i", _per_window(_build_up("1 hour", "5 minutes", 12, 9500), "1 hour", "w.aprovada", "sum(tempo_processamento_ms)")))
def _(spark, d):
    return alerts.value_build_up(eventos(spark, d), "1 hour", "5 minutes", 9500, _extras("sum"))


@query("extras_r4", sql(f"{R4_COLUMNS} peso:r", f"""{WEB} SELECT r.*, e.valor * 2 + e.tempo_processamento_ms AS peso
    FROM ({R4_SQL}) r JOIN web e ON e.id = r.transacao_id"""))
def _(spark, d):
    return alerts.location_change(eventos(spark, d), extras=_extras("row"))


@query("extras_r5", sql(f"{PIX_COLUMNS} peso:r", _per_row(_pix_high(5000))))
def _(spark, d):
    return alerts.pix_high_value(eventos(spark, d), 5000, _extras("row"))


@query("extras_r6", sql(f"{PIX_COLUMNS} peso:i", _per_window(
    _sweep("12 hours", 2), "12 hours", "w.tipo_transacao = 'PIX' AND w.status = 'AUTORIZADA'", "max(tempo_processamento_ms)")))
def _(spark, d):
    return alerts.pix_sweep(eventos(spark, d), "12 hours", 2, extras=_extras("group"))


@query("extras_r7", sql(f"{PIX_COLUMNS} peso:r", _per_row(R7_SQL)))
def _(spark, d):
    return alerts.pix_odd_hours(eventos(spark, d), extras=_extras("row"))


@query("extras_r8", sql(f"{PIX_COLUMNS} peso:i", _per_window(
    _cities("12 hours", "1 hour", 12, 2), "12 hours", "w.tipo_transacao = 'PIX'", "sum(tempo_processamento_ms)")))
def _(spark, d):
    return alerts.pix_many_cities(eventos(spark, d), "12 hours", "1 hour", 2, _extras("sum"))


@query("extras_r9", sql(f"{RISK_COLUMNS} peso:r", _per_row(_high_risk(0.45), "transaction_id")))
def _(spark, d):
    return alerts.high_risk(eventos(spark, d), 0.45, EVENT_DAY, _extras("row"))


@query("extras_r10", sql(f"{RISK_COLUMNS} peso:r", _per_row(PATTERN, "transaction_id")))
def _(spark, d):
    return alerts.suspicious_pattern(eventos(spark, d), EVENT_DAY, _extras("row"))


@query("flagged_accounts", sql("account_id:i", f"SELECT DISTINCT account_id FROM ({_high_risk(0.45)})"))
def _(spark, d):
    return alerts.flagged_accounts(alerts.risk_alerts(eventos(spark, d), 0.45, EVENT_DAY))


# --- features -------------------------------------------------------------------------------


@query("credit_features", sql(
    "conta_id:i event_timestamp:t saldo_atual:r saldo_medio_30d:r saldo_min_30d:r saldo_max_30d:r "
    "total_transacoes_30d:i volume_transacoes_30d:r ticket_medio_30d:r dias_desde_ultima_transacao:i qtd_contas:i "
    "limite_total:r utilizacao_limite_pct:r score_risco_medio_7d:r", f"""
    WITH u AS (SELECT conta_id, max(data_transacao) AS ultima FROM transacoes GROUP BY conta_id),
         f AS (SELECT t.conta_id, avg(valor) AS m, min(valor) AS lo, max(valor) AS hi, count(id) AS n, sum(valor) AS s
               FROM transacoes t JOIN u ON u.conta_id = t.conta_id
               WHERE t.data_transacao >= u.ultima - INTERVAL 30 DAY GROUP BY t.conta_id)
    SELECT c.id AS conta_id, TIMESTAMP '{BANK_DAY}' AS event_timestamp, c.saldo AS saldo_atual,
           coalesce(f.m, 0) AS saldo_medio_30d, coalesce(f.lo, 0) AS saldo_min_30d, coalesce(f.hi, 0) AS saldo_max_30d,
           coalesce(f.n, 0) AS total_transacoes_30d, coalesce(f.s, 0) AS volume_transacoes_30d,
           coalesce(f.m, 0) AS ticket_medio_30d, date_sub('day', u.ultima, TIMESTAMP '{BANK_DAY}') AS dias_desde_ultima_transacao,
           (SELECT count(*) FROM contas c2 WHERE c2.cliente_id = c.cliente_id) AS qtd_contas, c.limite AS limite_total,
           CASE WHEN c.limite > 0 THEN c.saldo / c.limite * 100 ELSE 0 END AS utilizacao_limite_pct,
           (SELECT avg(score_risco) FROM transacoes t2 WHERE t2.conta_id = c.id
             AND t2.data_transacao > TIMESTAMP '{BANK_DAY}' - INTERVAL 7 DAY) AS score_risco_medio_7d
    FROM contas c LEFT JOIN u ON u.conta_id = c.id LEFT JOIN f ON f.conta_id = c.id WHERE c.status = 'ATIVA'"""))
def _(spark, d):
    return features.credit_features(contas(spark, d), transacoes(spark, d), BANK_DAY)


FRAUD_FEATURES = (
    "transacao_id:i event_timestamp:t valor_transacao:r hora_do_dia:i dia_da_semana:i is_fim_de_semana:b "
    "is_horario_comercial:b transacoes_ultima_hora:i valor_acumulado_1h:r score_fraude_anterior:r is_aprovada:b"
)


def _fraud_features(bound: str) -> str:
    other = f"""FROM eventos o WHERE o.conta_id = t.conta_id AND o.id <> t.id
        AND o.data_transacao > t.data_transacao - INTERVAL 1 HOUR {bound}"""
    return f"""
    SELECT id AS transacao_id, data_transacao AS event_timestamp, valor AS valor_transacao, {HOUR} AS hora_do_dia,
           {DOW} AS dia_da_semana, {WEEKEND} AS is_fim_de_semana, {HOUR} BETWEEN 8 AND 18 AS is_horario_comercial,
           (SELECT count(*) {other}) AS transacoes_ultima_hora,
           (SELECT coalesce(sum(valor), 0) {other}) AS valor_acumulado_1h,
           score_risco AS score_fraude_anterior, aprovada AS is_aprovada
    FROM eventos t WHERE data_transacao > TIMESTAMP '{EVENT_DAY}' - INTERVAL 960 HOUR"""


@query("fraud_features", sql(FRAUD_FEATURES, _fraud_features("")))
def _(spark, d):
    return features.fraud_features(eventos(spark, d), EVENT_DAY, hours=960)


@query("fraud_features_past_only", sql(FRAUD_FEATURES, _fraud_features("AND o.data_transacao <= t.data_transacao")))
def _(spark, d):
    return features.fraud_features(eventos(spark, d), EVENT_DAY, hours=960, past_only=True)


@query("rolling_30d", sql(
    "id:i conta_id:i data_transacao:t valor:r janela_count:i janela_sum:r janela_avg:r janela_min:r janela_max:r", """
    SELECT id, conta_id, data_transacao, valor, count(*) OVER w AS janela_count, sum(valor) OVER w AS janela_sum,
           avg(valor) OVER w AS janela_avg, min(valor) OVER w AS janela_min, max(valor) OVER w AS janela_max
    FROM transacoes WINDOW w AS (PARTITION BY conta_id ORDER BY data_transacao
                                 RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW)"""))
def _(spark, d):
    return features.rolling_30d(transacoes(spark, d).select("id", "conta_id", "data_transacao", "valor"))


@query("rolling_7d_events", sql(
    "id:i janela_count:i janela_sum:r janela_avg:r janela_min:r janela_max:r", """
    SELECT id, count(*) OVER w AS janela_count, sum(valor) OVER w AS janela_sum,
           avg(valor) OVER w AS janela_avg, min(valor) OVER w AS janela_min, max(valor) OVER w AS janela_max
    FROM eventos WINDOW w AS (PARTITION BY conta_id ORDER BY data_transacao
                              RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)"""))
def _(spark, d):
    rows = features.rolling_30d(eventos(spark, d).select("id", "conta_id", "data_transacao", "valor"), days=7)
    return rows.drop("conta_id", "data_transacao", "valor")


@query("rolling_skewed", sql(
    "id:i janela_count:i janela_sum:r janela_avg:r janela_min:r janela_max:r", """
    SELECT id, count(*) OVER w AS janela_count, sum(valor) OVER w AS janela_sum,
           avg(valor) OVER w AS janela_avg, min(valor) OVER w AS janela_min, max(valor) OVER w AS janela_max
    FROM eventos WINDOW w AS (PARTITION BY conta_id % 2 ORDER BY data_transacao
                              RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)"""))
def _(spark, d):
    """Two accounts hold all rows."""
    rows = eventos(spark, d).select("id", (F.col("conta_id") % 2).alias("conta_id"), "data_transacao", "valor")
    return features.rolling_30d(rows, days=7).drop("conta_id", "data_transacao", "valor")


# Transactions with missing accounts, ids and times, and with ids that several rows share.
INCOMPLETE = """SELECT CASE WHEN id % 13 <> 0 THEN id // 3 END AS id, CASE WHEN id % 11 <> 0 THEN conta_id % 40 END AS conta_id,
        CASE WHEN id % 17 <> 0 THEN data_transacao END AS data_transacao, valor, id AS linha FROM eventos"""


def _incomplete(spark, d):
    rows, key = eventos(spark, d), F.col("id")
    return rows.select(
        F.when(key % 13 != 0, F.floor(key / 3)).alias("id"), F.when(key % 11 != 0, F.col("conta_id") % 40).alias("conta_id"),
        F.when(key % 17 != 0, F.col("data_transacao")).alias("data_transacao"), "valor", key.alias("linha"),
    )


def _others(bound: str) -> str:
    other = f"""FROM rows o WHERE o.conta_id = t.conta_id AND o.id <> t.id
        AND o.data_transacao > t.data_transacao - INTERVAL 1 HOUR {bound}"""
    return f"""WITH rows AS ({INCOMPLETE}) SELECT linha, (SELECT count(*) {other}) AS n, (SELECT coalesce(sum(valor), 0) {other}) AS s
        FROM rows t"""


@query("other_transactions_incomplete", sql("linha:i n:i s:r", f"SELECT * FROM ({_others('AND o.data_transacao <= t.data_transacao')}) AS eventos_"))
def _(spark, d):
    found = features.other_transactions_1h(_incomplete(spark, d), past_only=True)
    return found.select("linha", F.col("transacoes_ultima_hora").alias("n"), F.col("valor_acumulado_1h").alias("s"))


@query("other_transactions_open", sql("linha:i n:i s:r", f"SELECT * FROM ({_others('')}) AS eventos_"))
def _(spark, d):
    found = features.other_transactions_1h(_incomplete(spark, d))
    return found.select("linha", F.col("transacoes_ultima_hora").alias("n"), F.col("valor_acumulado_1h").alias("s"))


@query("point_in_time_incomplete", sql(
    "linha:i event_timestamp:t score:r", f"""
    WITH rows AS ({INCOMPLETE})
    SELECT r.linha, f.event_timestamp, f.score FROM rows r
    LEFT JOIN LATERAL (
        SELECT e.data_transacao AS event_timestamp, e.valor AS score FROM rows e
        WHERE e.conta_id = r.conta_id AND e.linha % 5 = 0 AND e.data_transacao <= r.data_transacao
        ORDER BY e.data_transacao DESC LIMIT 1) f ON true"""))
def _(spark, d):
    rows = _incomplete(spark, d)
    requests = rows.select("linha", "conta_id", F.col("data_transacao").alias("request_ts"))
    stored = rows.where("linha % 5 = 0").select("conta_id", F.col("data_transacao").alias("event_timestamp"), F.col("valor").alias("score"))
    view = features.FeatureView("rows", "conta_id", None, ("score",))
    return features.point_in_time(view, requests, stored).select("linha", "event_timestamp", "score")


@query("customer_features", sql(
    "cliente_id:i event_timestamp:t idade:i tempo_como_cliente_dias:i qtd_contas:i saldo_total:r "
    "volume_mensal_transacoes:i frequencia_transacoes_semanal:r tipos_produto_contratados:i tem_investimento:b risco_score:r classe_risco:s", f"""
    WITH n AS (SELECT conta_id, count(*) AS n30,
                      count(*) FILTER (data_transacao > TIMESTAMP '{BANK_DAY}' - INTERVAL 7 DAY) AS n7
               FROM transacoes WHERE data_transacao > TIMESTAMP '{BANK_DAY}' - INTERVAL 30 DAY GROUP BY conta_id),
         a AS (SELECT cliente_id, count(DISTINCT id) AS q, sum(saldo) AS s, sum(n30) AS n30, sum(n7) AS n7,
                      bool_or(tipo_conta = 'INVESTIMENTO') AS inv, count(DISTINCT tipo_conta) AS tipos
               FROM contas LEFT JOIN n ON n.conta_id = contas.id GROUP BY cliente_id)
    SELECT c.id AS cliente_id, TIMESTAMP '{BANK_DAY}' AS event_timestamp,
           date_sub('year', c.data_nascimento, DATE '{BANK_DAY}') AS idade, DATE '{BANK_DAY}' - c.created_at AS tempo_como_cliente_dias,
           coalesce(a.q, 0) AS qtd_contas, coalesce(a.s, 0) AS saldo_total, coalesce(a.n30, 0) AS volume_mensal_transacoes,
           coalesce(a.n7, 0) / 7.0e0 AS frequencia_transacoes_semanal, coalesce(a.tipos, 0) AS tipos_produto_contratados, coalesce(a.inv, false) AS tem_investimento,
           c.score_risco AS risco_score,
           CASE WHEN c.score_risco >= 800 THEN 'A' WHEN c.score_risco >= 600 THEN 'B'
                WHEN c.score_risco >= 400 THEN 'C' ELSE 'D' END AS classe_risco
    FROM clientes c LEFT JOIN a ON a.cliente_id = c.id WHERE c.status = 'ATIVO'"""))
def _(spark, d):
    return features.customer_features(clientes(spark, d), contas(spark, d), transacoes(spark, d), BANK_DAY)


@query("churn_features", sql(
    "cliente_id:i event_timestamp:t dias_desde_ultima_transacao:i transacoes_ultimo_mes:i transacoes_mes_anterior:i "
    "variacao_transacoes_pct:r canais_utilizados:i score_satisfacao:r", f"""
    WITH a AS (SELECT o.cliente_id, max(data_transacao) AS ultima, count(DISTINCT canal) AS canais,
                      count(*) FILTER (data_transacao > TIMESTAMP '{BANK_DAY}' - INTERVAL 30 DAY) AS m,
                      count(*) FILTER (data_transacao BETWEEN TIMESTAMP '{BANK_DAY}' - INTERVAL 60 DAY
                                       AND TIMESTAMP '{BANK_DAY}' - INTERVAL 30 DAY) AS p
               FROM transacoes t JOIN contas o ON o.id = t.conta_id GROUP BY o.cliente_id)
    SELECT c.id AS cliente_id, TIMESTAMP '{BANK_DAY}' AS event_timestamp,
           date_sub('day', a.ultima, TIMESTAMP '{BANK_DAY}') AS dias_desde_ultima_transacao,
           coalesce(a.m, 0) AS transacoes_ultimo_mes, coalesce(a.p, 0) AS transacoes_mes_anterior,
           CASE WHEN a.p > 0 THEN (a.m - a.p) * 1.0e0 / a.p * 100 END AS variacao_transacoes_pct,
           coalesce(a.canais, 0) AS canais_utilizados, c.score_risco AS score_satisfacao
    FROM clientes c LEFT JOIN a ON a.cliente_id = c.id WHERE c.status = 'ATIVO'"""))
def _(spark, d):
    return features.churn_features(clientes(spark, d), contas(spark, d), transacoes(spark, d), BANK_DAY)


def _with_place(rows):
    return rows.withColumns({
        "latitude": -33.0 + (F.col("id") % 380) / 10.0,
        "longitude": -73.0 + (F.col("id") % 390) / 10.0,
    })


DISTANCE_SQL = """
    WITH p AS (SELECT id, conta_id, data_transacao, -33.0e0 + (id % 380) / 10.0e0 AS la, -73.0e0 + (id % 390) / 10.0e0 AS lo
               FROM eventos),
         q AS (SELECT *, lag(la) OVER w AS pla, lag(lo) OVER w AS plo FROM p
               WINDOW w AS (PARTITION BY conta_id ORDER BY data_transacao, id))
    SELECT id, 2 * 6371.0088e0 * asin(sqrt(pow(sin(radians(la - pla) / 2), 2)
           + cos(radians(pla)) * cos(radians(la)) * pow(sin(radians(lo - plo) / 2), 2))) AS distancia_ultima_transacao_km
    FROM q"""


@query("distance_to_previous", sql(
    "id:i distancia_ultima_transacao_km:r", DISTANCE_SQL))
def _(spark, d):
    rows = features.distance_to_previous(_with_place(eventos(spark, d)))
    return rows.select("id", "distancia_ultima_transacao_km")


NEW_DEVICES_SQL = """
    SELECT id, 'D' || (id % 11) AS dispositivo,
           row_number() OVER (PARTITION BY conta_id, id % 11 ORDER BY data_transacao, id) = 1 AS is_novo_dispositivo
    FROM eventos"""


@query("new_devices", sql(
    "id:i dispositivo:s is_novo_dispositivo:b", NEW_DEVICES_SQL))
def _(spark, d):
    rows = eventos(spark, d).withColumn("dispositivo", F.concat(F.lit("D"), F.col("id") % 11))
    return features.new_devices(rows).select("id", "dispositivo", "is_novo_dispositivo")


DEVICES_SQL = """
    SELECT id, (SELECT count(DISTINCT o.id % 11) FROM eventos o WHERE o.conta_id = t.conta_id
                AND o.data_transacao BETWEEN t.data_transacao - INTERVAL 30 DAY AND t.data_transacao) AS qtd_dispositivos_30d
    FROM eventos t"""


@query("devices_30d", sql(
    "id:i qtd_dispositivos_30d:i", DEVICES_SQL))
def _(spark, d):
    rows = eventos(spark, d).withColumn("dispositivo", F.concat(F.lit("D"), F.col("id") % 11))
    return features.recent_devices(rows).select("id", "qtd_dispositivos_30d")


@query("fraud_features_context", sql(
    f"{FRAUD_FEATURES} distancia_ultima_transacao_km:r qtd_dispositivos_30d:i is_novo_dispositivo:b", f"""
    SELECT f.*, p.distancia_ultima_transacao_km, d.qtd_dispositivos_30d, n.is_novo_dispositivo
    FROM ({_fraud_features("")}) f JOIN ({DISTANCE_SQL}) p ON p.id = f.transacao_id JOIN ({DEVICES_SQL}) d ON d.id = f.transacao_id
    JOIN ({NEW_DEVICES_SQL}) n ON n.id = f.transacao_id"""))
def _(spark, d):
    rows = _with_place(eventos(spark, d)).withColumn("dispositivo", F.concat(F.lit("D"), F.col("id") % 11))
    return features.fraud_features(rows, EVENT_DAY, hours=960)


@query("point_in_time_features", sql(
    "conta_id:i request_ts:t event_timestamp:t score:r", """
    SELECT r.conta_id, r.request_ts, f.event_timestamp, f.score
    FROM (SELECT id, conta_id, data_transacao AS request_ts FROM eventos) r
    LEFT JOIN LATERAL (
        SELECT e.data_transacao AS event_timestamp, e.score_risco AS score FROM eventos e
        WHERE e.conta_id = r.conta_id AND e.tipo_transacao = 'PIX' AND e.data_transacao <= r.request_ts
          AND e.data_transacao >= r.request_ts - INTERVAL 1 DAY
        ORDER BY e.data_transacao DESC LIMIT 1) f ON true"""))
def _(spark, d):
    rows = eventos(spark, d)
    requests = rows.select("conta_id", F.col("data_transacao").alias("request_ts"))
    stored = rows.where(F.col("tipo_transacao") == "PIX").select(
        "conta_id", F.col("data_transacao").alias("event_timestamp"), F.col("score_risco").alias("score")
    )
    return features.point_in_time(features.CATALOGUE["credit_features"], requests, stored)


@query("materialize_features", sql(
    "cliente_id:i event_timestamp:t risco_score:r", """
    SELECT cliente_id, CAST(ts AS TIMESTAMP) AS event_timestamp, s AS risco_score FROM (
        SELECT id AS cliente_id, CASE WHEN status = 'ATIVO' AND created_at > DATE '1994-06-01' AND created_at <= DATE '1995-03-01'
                    THEN created_at ELSE DATE '1994-01-01' END AS ts,
               CASE WHEN status = 'ATIVO' AND created_at > DATE '1994-06-01' AND created_at <= DATE '1995-03-01'
                    THEN score_risco ELSE 0 END AS s
        FROM clientes)"""))
def _(spark, d):
    people = clientes(spark, d)
    store = people.select(
        F.col("id").alias("cliente_id"), F.lit("1994-01-01").cast("timestamp").alias("event_timestamp"),
        F.lit(0.0).alias("risco_score"),
    )
    fresh = people.where(F.col("status") == "ATIVO").select(
        F.col("id").alias("cliente_id"), F.col("created_at").cast("timestamp").alias("event_timestamp"),
        F.col("score_risco").alias("risco_score"),
    )
    view = features.CATALOGUE["customer_features"]
    return features.materialize_incremental(view, store, fresh, "1994-06-01", "1995-03-01")


@query("keep_latest", sql(
    "tipo_transacao:s id:i data_transacao:t", """
    SELECT tipo_transacao, id, data_transacao FROM eventos
    QUALIFY row_number() OVER (PARTITION BY tipo_transacao ORDER BY data_transacao DESC) <= 100"""))
def _(spark, d):
    return keep_latest(eventos(spark, d), ["tipo_transacao"], "data_transacao").select(
        "tipo_transacao", "id", "data_transacao"
    )
