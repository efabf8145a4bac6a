"""Alert rules. Each takes a batch or streaming DataFrame of transactions and returns alerts.

Fixed values: the alert ids, kinds, scores, levels, texts and recommendations below are the record
format consumers of the alerts rely on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import AsOf, is_night, moment
from ..functions.extras import NONE, Extras
from ..schemas import MONEY
from .enrich import is_suspicious, score_transaction
from .ordered import previous_row
from .windows import distinct_in_hops, hopping, tumbling


def _money(column: Column) -> Column:
    return column.cast(MONEY)


def _text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def _graded(value: Column, steps: Sequence[tuple[float, object]], otherwise: object, strict: bool) -> Column:
    out = F
    for cut, result in steps:
        out = out.when(value > cut if strict else value >= cut, F.lit(result))
    return out.otherwise(F.lit(otherwise))


def _fraud(
    df: DataFrame, *, alert_id: Column, kind: str, score: Column, level: Column, text: Column, rule: str,
    amount: Column, ts: Column, action: str, transaction: Column, place: bool, more: Sequence[Column] = (),
) -> DataFrame:
    def local(name: str) -> Column:
        return (F.col(name) if place else F.lit("")).alias(name)

    return df.select(
        alert_id.alias("alerta_id"), "conta_id", transaction.alias("transacao_id"),
        F.lit(kind).alias("tipo_fraude"), score.alias("score_fraude"), level.alias("nivel_risco"),
        text.alias("descricao"), F.lit(rule).alias("regras_acionadas"), amount.alias("valor_transacao"),
        local("canal"), local("cidade"), local("estado"),
        ts.alias("timestamp_alerta"), F.lit(action).alias("recomendacao"), *more,
    )


# Units in the alerts' texts, one and many, and short.
_UNITS = {"second": ("segundo", "segundos", "s"), "minute": ("minuto", "minutos", "min"), "hour": ("hora", "horas", "h"), "day": ("dia", "dias", "d")}


def _span(size: str, short: bool = False) -> str:
    """A window's length as the texts put it: ``5 minutes`` is 5 minutos, or 5min."""
    number, unit = size.split()
    one, many, brief = _UNITS[unit.rstrip("s")]
    return f"{number}{brief}" if short else f"{number} {one if number == '1' else many}"


def high_value_at_night(df: DataFrame, limit: float = 10000, extras: Extras = NONE) -> DataFrame:
    """R1."""
    ts = F.col("data_transacao")
    amount = _money(F.col("valor"))
    return extras.checked(_fraud(
        extras.rows(df).where((F.col("valor") > limit) & is_night(ts)),
        alert_id=F.concat(F.lit("ALT-R1-"), F.col("id").cast("string")),
        kind="ALTO_VALOR_NOTURNO", score=F.lit(0.85), level=F.lit("ALTO"),
        text=F.concat(F.lit("Transação de alto valor (R$ "), amount.cast("string"), F.lit(") em horário noturno")),
        rule="REGRA_1_ALTO_VALOR_NOTURNO", amount=amount, ts=ts, action="BLOQUEAR_E_VERIFICAR",
        transaction=F.col("id"), place=True, more=extras.columns(),
    ))


def rapid_transactions(df: DataFrame, size: str = "1 minute", minimum: int = 3, extras: Extras = NONE) -> DataFrame:
    """R2: many approved transactions of an account in one tumbling window."""
    counts = tumbling(
        extras.rows(df).where(F.col("aprovada")), size, ["conta_id"],
        {"_n": F.count(F.lit(1)), "_total": F.sum("valor"), **extras.measures}, "data_transacao",
    ).where(F.col("_n") >= minimum)
    n = F.col("_n")
    return extras.checked(_fraud(
        counts,
        alert_id=F.concat(F.lit("ALT-R2-"), F.col("conta_id").cast("string"), F.lit("-"), _text(F.col("window_start"))),
        kind="TRANSACOES_RAPIDAS",
        score=_graded(n, [(10, 0.95), (5, 0.80)], 0.60, strict=False),
        level=_graded(n, [(10, "CRITICO"), (5, "ALTO")], "MEDIO", strict=False),
        text=F.concat(n.cast("string"), F.lit(f" transações em {_span(size)} da conta")),
        rule="REGRA_2_TRANSACOES_RAPIDAS", amount=_money(F.col("_total")), ts=F.col("window_end"),
        action="REVISAO_MANUAL", transaction=F.lit(0).cast("long"), place=False, more=[F.col(m) for m in extras.measures],
    ))


def value_build_up(
    df: DataFrame, size: str = "5 minutes", slide: str = "1 minute", limit: float = 20000, extras: Extras = NONE
) -> DataFrame:
    """R3: approved value of an account over a sliding window."""
    sums = hopping(
        extras.rows(df).where(F.col("aprovada")), size, slide, ["conta_id"], {"_total": F.col("valor"), **extras.measures}, "data_transacao"
    ).where(F.col("_total") > limit)
    total, amount = F.col("_total"), _money(F.col("_total"))
    return extras.checked(_fraud(
        sums,
        alert_id=F.concat(F.lit("ALT-R3-"), F.col("conta_id").cast("string"), F.lit("-"), _text(F.col("window_end"))),
        kind="ACUMULO_VALOR",
        score=_graded(total, [(50000, 0.98), (30000, 0.90)], 0.75, strict=True),
        level=_graded(total, [(50000, "CRITICO"), (30000, "ALTO")], "MEDIO", strict=True),
        text=F.concat(F.lit("Acumulo de R$ "), amount.cast("string"), F.lit(f" em {_span(size)} da conta")),
        rule="REGRA_3_ACUMULO_VALOR", amount=amount, ts=F.col("window_end"),
        action="BLOQUEAR_E_VERIFICAR", transaction=F.lit(0).cast("long"), place=False, more=[F.col(m) for m in extras.measures],
    ))


def location_change(df: DataFrame, known: DataFrame | None = None, extras: Extras = NONE) -> DataFrame:
    """R4: the city differs from the account's previous transaction.

    ``known`` has earlier transactions that may be a previous one but raise no alert themselves; so do those of ``df`` for
    which the condition of ``extras`` does not hold.
    """
    columns = ["conta_id", "id", "cidade", "data_transacao"]
    able = F.lit(True) if extras.where is None else F.coalesce(extras.where, F.lit(False))
    rows = df.select(*columns, able.alias("novo"), *extras.columns())
    if known is not None:
        rows = rows.unionByName(known.select(*columns, F.lit(False).alias("novo")), allowMissingColumns=True)
    rows = previous_row(rows, "conta_id", "data_transacao", "id", ["cidade", "data_transacao"])
    changed = rows.where(F.col("novo") & (F.col("cidade") != F.col("prev_cidade")))
    return extras.checked(changed.select(
        F.concat(F.lit("ALT-R4-"), F.col("id").cast("string")).alias("alerta_id"),
        "conta_id",
        F.col("id").alias("transacao_id"),
        F.lit("DESVIO_GEOGRAFICO").alias("tipo_fraude"),
        F.col("prev_cidade").alias("cidade_anterior"),
        "cidade",
        F.col("prev_data_transacao").alias("timestamp_anterior"),
        F.col("data_transacao").alias("timestamp_alerta"), *[F.col(m) for m in extras.measures],
    ))


def _pix(
    df: DataFrame, *, alert_id: Column, kind: str, amount: Column, text: Column, score: Column, ts: Column,
    action: str, transaction: Column, more: Sequence[Column] = (),
) -> DataFrame:
    return df.select(
        alert_id.alias("alerta_id"), "conta_id", transaction.alias("transacao_id"), F.lit(kind).alias("tipo_alerta"),
        amount.alias("valor_transacao"), text.alias("descricao"), score.alias("score_risco"),
        ts.alias("timestamp_alerta"), F.lit(action).alias("recomendacao"), *more,
    )


def _only_pix(df: DataFrame) -> DataFrame:
    return df.where(F.col("tipo_transacao") == "PIX")


def pix_high_value(df: DataFrame, limit: float = 50000, extras: Extras = NONE) -> DataFrame:
    """R5."""
    amount = _money(F.col("valor"))
    return extras.checked(_pix(
        _only_pix(extras.rows(df)).where(F.col("valor") > limit),
        alert_id=F.concat(F.lit("PIX-CEP1-"), F.col("id").cast("string")), kind="PIX_ALTO_VALOR", amount=amount,
        text=F.concat(F.lit("PIX de R$ "), amount.cast("string")), score=F.col("score_risco"),
        ts=F.col("data_transacao"), action="VERIFICACAO_MANUAL_OBRIGATORIA", transaction=F.col("id"),
        more=extras.columns(),
    ))


def pix_sweep(
    df: DataFrame, size: str = "5 minutes", minimum: int = 5, status: str = "AUTORIZADA", extras: Extras = NONE
) -> DataFrame:
    """R6: many authorised PIX of an account in one tumbling window."""
    counts = tumbling(
        _only_pix(extras.rows(df)).where(F.col("status") == status), size, ["conta_id"],
        {"_n": F.count(F.lit(1)), "_total": F.sum("valor"), **extras.measures}, "data_transacao",
    ).where(F.col("_n") >= minimum)
    return extras.checked(_pix(
        counts,
        alert_id=F.concat(F.lit("PIX-CEP2-"), F.col("conta_id").cast("string"), F.lit("-"), _text(F.col("window_end"))),
        kind="PIX_VARREDURA", amount=_money(F.col("_total")),
        text=F.concat(F.col("_n").cast("string"), F.lit(f" PIX em {_span(size, short=True)}")), score=F.lit(0.85), ts=F.col("window_end"),
        action="BLOQUEAR_PROXIMOS_PIX", transaction=F.lit(0).cast("long"), more=[F.col(m) for m in extras.measures],
    ))


def pix_odd_hours(df: DataFrame, limit: float = 5000, extras: Extras = NONE) -> DataFrame:
    """R7: the score is raised to at least 0.7 and stays NULL when unknown."""
    ts, score, amount = F.col("data_transacao"), F.col("score_risco"), _money(F.col("valor"))
    return extras.checked(_pix(
        _only_pix(extras.rows(df)).where((F.col("valor") > limit) & is_night(ts)),
        alert_id=F.concat(F.lit("PIX-CEP3-"), F.col("id").cast("string")), kind="PIX_HORARIO_ANOMALO", amount=amount,
        text=F.concat(F.lit("PIX R$ "), amount.cast("string"), F.lit(" as "), F.hour(ts).cast("string"), F.lit("h")),
        score=F.when(score.isNotNull(), F.greatest(score, F.lit(0.7))), ts=ts, action="NOTIFICAR_CLIENTE",
        transaction=F.col("id"), more=extras.columns(),
    ))


def pix_many_cities(
    df: DataFrame, size: str = "1 hour", slide: str = "5 minutes", minimum: int = 3, extras: Extras = NONE
) -> DataFrame:
    """R8: PIX of an account from several cities within a sliding window."""
    cities = distinct_in_hops(
        _only_pix(extras.rows(df)), size, slide, "conta_id", "cidade", {"_total": F.col("valor"), **extras.measures}, "data_transacao"
    ).where(F.col("distintos") >= minimum)
    return extras.checked(_pix(
        cities,
        alert_id=F.concat(F.lit("PIX-CEP4-"), F.col("conta_id").cast("string"), F.lit("-"), _text(F.col("window_end"))),
        kind="PIX_MULTI_CIDADE", amount=_money(F.col("_total")),
        text=F.concat(F.col("distintos").cast("string"), F.lit(f" cidades em {_span(size, short=True)}")), score=F.lit(0.92),
        ts=F.col("window_end"), action="BLOQUEAR_CONTA", transaction=F.lit(0).cast("long"),
        more=[F.col(m) for m in extras.measures],
    ))


def _risk(when: Column, prefix: str, kind: str, text: Column, action: str, score: Column, as_of: AsOf) -> Column:
    """The alert where the condition holds, else NULL."""
    now = moment(as_of)
    key = F.concat(F.lit(f"{prefix}_"), F.col("conta_id").cast("string"), F.lit("_"), F.unix_seconds(now).cast("string"))
    alert = F.struct(
        key.alias("alert_id"), F.col("conta_id").alias("account_id"), F.col("id").alias("transaction_id"),
        score.cast("double").alias("risk_score"), F.lit(kind).alias("alert_type"), text.alias("description"),
        now.alias("timestamp"), F.lit(action).alias("recommended_action"),
    )
    return F.when(when, alert)


def _high_risk(threshold: float, as_of: AsOf) -> Column:
    score = F.col("calculated_risk_score")
    text = F.concat(F.lit("Transação de alto risco detectada: R$ "), _money(F.col("valor")).cast("string"))
    return _risk(score > threshold, "risk", "HIGH_RISK_TRANSACTION", text, "REVIEW_MANUAL", score, as_of)


def _pattern(df: DataFrame, as_of: AsOf) -> Column:
    text = F.lit("Padrão suspeito detectado na transação")
    return _risk(is_suspicious(df), "pattern", "SUSPICIOUS_PATTERN", text, "INVESTIGATE", F.lit(None), as_of)


def _raise(df: DataFrame, extras: Extras, *alerts: Column) -> DataFrame:
    raised = extras.rows(df).select(F.inline(F.array_compact(F.array(*alerts))), *extras.columns())
    return extras.checked(raised)


def high_risk(df: DataFrame, threshold: float = 0.7, as_of: AsOf = None, extras: Extras = NONE) -> DataFrame:
    """R9: the score tops out at 0.7, so the default threshold never fires."""
    return _raise(score_transaction(df, as_of), extras, _high_risk(threshold, as_of))


def suspicious_pattern(df: DataFrame, as_of: AsOf = None, extras: Extras = NONE) -> DataFrame:
    """R10."""
    return _raise(df, extras, _pattern(df, as_of))


def risk_alerts(df: DataFrame, threshold: float = 0.7, as_of: AsOf = None, extras: Extras = NONE) -> DataFrame:
    """R9 and R10 in one pass; one transaction may raise both."""
    return _raise(score_transaction(df, as_of), extras, _high_risk(threshold, as_of), _pattern(df, as_of))


def flagged_accounts(alerts: DataFrame) -> DataFrame:
    """Accounts that ever raised a high-risk alert."""
    return alerts.where(F.col("alert_type") == "HIGH_RISK_TRANSACTION").select("account_id").dropDuplicates()
