"""Feature sets, point-in-time lookup and incremental materialisation."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bitmaps import distinct_counts
from ..functions.columns import AsOf, ago, business_hours, day_of_week, haversine_km, is_weekend, moment, ratio, today
from .enrich import classe_risco
from .latest import upsert
from .ordered import asof_latest, previous_row, rolling_stats, running_steps, totals_after


@dataclass(frozen=True)
class FeatureView:
    name: str
    entity: str
    ttl: timedelta
    features: tuple[str, ...]
    event_timestamp: str = "event_timestamp"

    def check(self, df: DataFrame) -> dict[str, list[str]]:
        """Declared features the data lacks, and columns nobody declared."""
        known = {self.entity, self.event_timestamp, *self.features}
        return {
            "missing": [c for c in (self.entity, self.event_timestamp, *self.features) if c not in df.columns],
            "extra": [c for c in df.columns if c not in known],
        }

    def conform(self, df: DataFrame, dtype: str = "double") -> DataFrame:
        """The declared columns in their order: undeclared ones go, features without source data are NULL."""
        columns = [F.col(c) if c in df.columns else F.lit(None).cast(dtype).alias(c) for c in self.features]
        return df.select(self.entity, self.event_timestamp, *columns)


# The declared feature views.
CATALOGUE = {
    v.name: v
    for v in (
        FeatureView("credit_features", "conta_id", timedelta(days=1), (
            "saldo_atual", "saldo_medio_30d", "saldo_min_30d", "saldo_max_30d", "total_transacoes_30d",
            "volume_transacoes_30d", "ticket_medio_30d", "dias_desde_ultima_transacao", "qtd_contas",
            "limite_total", "utilizacao_limite_pct", "score_risco_medio_7d",
        )),
        FeatureView("fraud_features", "transacao_id", timedelta(hours=1), (
            "valor_transacao", "hora_do_dia", "dia_da_semana", "is_fim_de_semana", "is_horario_comercial",
            "transacoes_ultima_hora", "valor_acumulado_1h", "distancia_ultima_transacao_km",
            "score_fraude_anterior", "qtd_dispositivos_30d", "is_novo_dispositivo", "risco_canal",
        )),
        FeatureView("customer_features", "cliente_id", timedelta(days=7), (
            "idade", "tempo_como_cliente_dias", "qtd_contas", "saldo_total", "volume_mensal_transacoes",
            "frequencia_transacoes_semanal", "tipos_produto_contratados", "tem_emprestimo", "tem_cartao",
            "tem_investimento", "risco_score", "classe_risco",
        )),
        FeatureView("churn_features", "cliente_id", timedelta(days=1), (
            "dias_desde_ultimo_login", "dias_desde_ultima_transacao", "transacoes_ultimo_mes",
            "transacoes_mes_anterior", "variacao_transacoes_pct", "saldo_medio_90d", "saldo_atual",
            "variacao_saldo_pct", "qtd_reclamacoes_90d", "tempo_medio_resposta_min", "canais_utilizados",
            "score_satisfacao",
        )),
    )
}


def _whole_days(since: Column, as_of: AsOf) -> Column:
    """Completed days between a time and the evaluation time."""
    return F.floor((F.unix_micros(moment(as_of)) - F.unix_micros(since)) / 86_400_000_000).cast("int")


def rolling_30d(transacoes: DataFrame, days: int = 30) -> DataFrame:
    """Each transaction with the figures of its account over the 30 days up to it."""
    return rolling_stats(
        transacoes, "conta_id", "data_transacao", "valor", timedelta(days=days), prefix="janela_"
    )


def credit_features(contas: DataFrame, transacoes: DataFrame, as_of: AsOf = None, status: str = "ATIVA") -> DataFrame:
    """One row per active account; the 30-day figures are those at its last transaction.

    Only the last frame of an account is needed, so its end is found by one aggregate and its rows
    by a second; no per-row window runs over the transactions.
    """
    active = contas.where(F.col("status") == status)
    transacoes = transacoes.join(active.select(F.col("id").alias("conta_id")), "conta_id", "left_semi")
    ts = F.col("data_transacao")
    recent_score = F.avg(F.when(ts > ago("7 days", as_of), F.col("score_risco")))
    ends = transacoes.groupBy("conta_id").agg(
        F.max(ts).alias("ultima"), recent_score.alias("score_risco_medio_7d")
    )
    frame = (
        transacoes.join(ends.select("conta_id", "ultima"), "conta_id")
        .where(ts >= F.col("ultima") - F.expr("INTERVAL 30 DAYS"))
        .groupBy("conta_id")
        .agg(
            F.avg("valor").alias("saldo_medio_30d"),
            F.min("valor").alias("saldo_min_30d"),
            F.max("valor").alias("saldo_max_30d"),
            F.count("id").alias("total_transacoes_30d"),
            F.sum("valor").alias("volume_transacoes_30d"),
        )
    )
    owned = contas.groupBy("cliente_id").agg(F.count(F.lit(1)).alias("qtd_contas"))
    zero = ["saldo_medio_30d", "saldo_min_30d", "saldo_max_30d", "total_transacoes_30d", "volume_transacoes_30d"]
    return (
        active.select(F.col("id").alias("conta_id"), "cliente_id", "saldo", "limite")
        .join(ends, "conta_id", "left")
        .join(frame, "conta_id", "left")
        .join(owned, "cliente_id", "left")
        .fillna(0, zero)
        .select(
            "conta_id",
            moment(as_of).alias("event_timestamp"),
            F.col("saldo").alias("saldo_atual"),
            *zero,
            F.col("saldo_medio_30d").alias("ticket_medio_30d"),
            _whole_days(F.col("ultima"), as_of).alias("dias_desde_ultima_transacao"),
            "qtd_contas",
            F.col("limite").alias("limite_total"),
            (ratio(F.col("saldo"), F.col("limite")) * 100).alias("utilizacao_limite_pct"),
            "score_risco_medio_7d",
        )
    )


def other_transactions_1h(
    transacoes: DataFrame, past_only: bool = False, lookback: timedelta = timedelta(hours=1)
) -> DataFrame:
    """Number and value of the account's other transactions later than one hour before each one.

    As specified there is no upper bound, so later transactions count too; ``past_only`` stops at
    the transaction itself. Rows with the same ``id`` are no other transactions, rows without
    account, time or id neither have any nor are any.
    """
    named = F.col("id").isNotNull()
    if past_only:
        rows = rolling_stats(
            transacoes, "conta_id", "data_transacao", "valor", lookback, open_start=True, slots=60, counted=named, prefix="_w"
        )
    else:
        rows = totals_after(transacoes, "conta_id", "data_transacao", "valor", lookback, counted=named, prefix="_w")
    span = lookback // timedelta(microseconds=1)
    same = Window.partitionBy("conta_id", "id").orderBy(F.unix_micros("data_transacao")).rangeBetween(
        1 - span, Window.currentRow if past_only else Window.unboundedFollowing
    )
    complete = F.col("conta_id").isNotNull() & named & F.col("data_transacao").isNotNull()
    zero = F.lit(0)
    own_value = F.coalesce(F.sum("valor").over(same), zero)
    return rows.withColumns({
        "transacoes_ultima_hora": F.when(complete, F.col("_wcount") - F.count(F.lit(1)).over(same)).otherwise(zero),
        "valor_acumulado_1h": F.when(complete, F.coalesce(F.col("_wsum"), zero) - own_value).otherwise(zero),
    }).drop("_wcount", "_wsum", "_wavg", "_wmin", "_wmax")


def fraud_features(
    transacoes: DataFrame, as_of: AsOf = None, hours: int = 24, past_only: bool = False
) -> DataFrame:
    """Transactions of the last hours with their context.

    Nothing earlier than one more hour can be in a look-back, so the scan starts there. Where transactions have a place
    (``latitude``, ``longitude``) or a ``dispositivo``, the distance from the one before and the devices are attached; for
    these the whole history is read, of the accounts that were active in those hours.
    """
    ts = F.col("data_transacao")
    recent = ts > ago(f"{hours} hours", as_of)
    needed = transacoes.where(ts > ago(f"{hours + 1} hours", as_of))
    rows = _with_context(other_transactions_1h(needed, past_only).where(recent), transacoes, recent)
    context = [c for c in CONTEXT if c in rows.columns and c not in transacoes.columns]
    return rows.select(
        F.col("id").alias("transacao_id"),
        ts.alias("event_timestamp"),
        F.col("valor").alias("valor_transacao"),
        F.hour(ts).alias("hora_do_dia"),
        day_of_week(ts, "postgres").alias("dia_da_semana"),
        is_weekend(ts).alias("is_fim_de_semana"),
        business_hours(ts, 8, 18).alias("is_horario_comercial"),
        "transacoes_ultima_hora",
        "valor_acumulado_1h",
        F.col("score_risco").alias("score_fraude_anterior"),
        F.col("aprovada").alias("is_aprovada"),
        *context,
    )


CONTEXT = ("distancia_ultima_transacao_km", "qtd_dispositivos_30d", "is_novo_dispositivo")


def _with_context(rows: DataFrame, transacoes: DataFrame, wanted: Column) -> DataFrame:
    """The wanted rows with distance and devices, where the transactions have what these take.

    Both are looked up in the history of the rows' accounts. Rows that repeat account, time and id share the smaller distance.
    """
    active = transacoes.where(wanted & F.col("conta_id").isNotNull()).select("conta_id").distinct()
    history = transacoes.join(active, "conta_id", "left_semi")
    if {"latitude", "longitude"} <= set(transacoes.columns):
        key = ["conta_id", "data_transacao", "id"]
        apart = distance_to_previous(history.select(*key, "latitude", "longitude")).where(wanted)
        rows = rows.join(apart.groupBy(*key).agg(F.min(CONTEXT[0]).alias(CONTEXT[0])), key, "left")
    return new_devices(recent_devices(rows, uses=history), uses=history) if "dispositivo" in transacoes.columns else rows


def _per_customer(contas: DataFrame, per_account: DataFrame) -> DataFrame:
    """Account sums with the account owner."""
    accounts = contas.select(F.col("id").alias("conta_id"), "cliente_id", "saldo", "tipo_conta")
    return accounts.join(per_account, "conta_id", "left")


def customer_features(
    clientes: DataFrame, contas: DataFrame, transacoes: DataFrame, as_of: AsOf = None, status: str = "ATIVO"
) -> DataFrame:
    ts = F.col("data_transacao")
    recent = (
        transacoes.where(ts > ago("30 days", as_of))
        .groupBy("conta_id")
        .agg(F.count(F.lit(1)).alias("n30"), F.count_if(ts > ago("7 days", as_of)).alias("n7"))
    )
    owned = _per_customer(contas, recent).groupBy("cliente_id").agg(
        F.countDistinct("conta_id").alias("qtd_contas"),
        F.sum("saldo").alias("saldo_total"),
        F.sum("n30").alias("volume_mensal_transacoes"),
        F.sum("n7").alias("n7"),
        F.max(F.col("tipo_conta") == "INVESTIMENTO").alias("tem_investimento"),
    )
    products = distinct_counts(contas, "cliente_id", values={"tipos_produto_contratados": "tipo_conta"})
    joined = (
        clientes.where(F.col("status") == status)
        .select(F.col("id").alias("cliente_id"), "data_nascimento", "created_at", "score_risco")
        .join(owned, "cliente_id", "left")
        .join(products, "cliente_id", "left")
        .fillna(0, ["qtd_contas", "saldo_total", "volume_mensal_transacoes", "n7", "tipos_produto_contratados"])
    )
    return joined.select(
        "cliente_id",
        moment(as_of).alias("event_timestamp"),
        F.floor(F.months_between(today(as_of), "data_nascimento") / 12).cast("int").alias("idade"),
        _whole_days(F.col("created_at").cast("timestamp"), as_of).alias("tempo_como_cliente_dias"),
        "qtd_contas",
        "saldo_total",
        "volume_mensal_transacoes",
        (F.col("n7") / 7.0).alias("frequencia_transacoes_semanal"),
        F.col("tipos_produto_contratados").cast("int").alias("tipos_produto_contratados"),
        F.coalesce("tem_investimento", F.lit(False)).alias("tem_investimento"),
        F.col("score_risco").alias("risco_score"),
        classe_risco(F.col("score_risco")).alias("classe_risco"),
    )


def churn_features(
    clientes: DataFrame, contas: DataFrame, transacoes: DataFrame, as_of: AsOf = None, status: str = "ATIVO"
) -> DataFrame:
    ts = F.col("data_transacao")
    before = ts.between(ago("60 days", as_of), ago("30 days", as_of))
    # One row per account and channel keeps the channel count exact without touching rows again.
    per_account = transacoes.groupBy("conta_id", "canal").agg(
        F.max(ts).alias("ultima"),
        F.count_if(ts > ago("30 days", as_of)).alias("mes"),
        F.count_if(before).alias("anterior"),
    )
    owned = _per_customer(contas, per_account).groupBy("cliente_id").agg(
        F.max("ultima").alias("ultima"),
        F.sum("mes").alias("transacoes_ultimo_mes"),
        F.sum("anterior").alias("transacoes_mes_anterior"),
        F.countDistinct("canal").alias("canais_utilizados"),
    )
    counts = ["transacoes_ultimo_mes", "transacoes_mes_anterior", "canais_utilizados"]
    joined = (
        clientes.where(F.col("status") == status)
        .select(F.col("id").alias("cliente_id"), "score_risco")
        .join(owned, "cliente_id", "left")
        .fillna(0, counts)
    )
    last, previous = F.col("transacoes_ultimo_mes"), F.col("transacoes_mes_anterior")
    return joined.select(
        "cliente_id",
        moment(as_of).alias("event_timestamp"),
        _whole_days(F.col("ultima"), as_of).alias("dias_desde_ultima_transacao"),
        *counts[:2],
        F.when(previous > 0, (last - previous) / previous * 100.0).alias("variacao_transacoes_pct"),
        "canais_utilizados",
        F.col("score_risco").alias("score_satisfacao"),
    )


def distance_to_previous(transacoes: DataFrame) -> DataFrame:
    """Distance in km from the account's previous transaction."""
    rows = previous_row(transacoes, "conta_id", "data_transacao", "id", ["latitude", "longitude"])
    km = haversine_km(F.col("prev_latitude"), F.col("prev_longitude"), F.col("latitude"), F.col("longitude"))
    return rows.withColumn("distancia_ultima_transacao_km", km).drop("prev_latitude", "prev_longitude")


def new_devices(transacoes: DataFrame, uses: DataFrame | None = None) -> DataFrame:
    """Transactions flagged when they are the first of their device on the account.

    ``uses`` has the transactions to look in, where those are not ``transacoes`` themselves.
    """
    first = (transacoes if uses is None else uses).groupBy("conta_id", "dispositivo").agg(
        F.min(F.struct("data_transacao", "id")).alias("primeira")
    )
    joined = transacoes.join(first, ["conta_id", "dispositivo"], "left")
    here = F.struct("data_transacao", "id")
    return joined.withColumn("is_novo_dispositivo", F.coalesce(F.col("primeira") == here, F.lit(False))).drop("primeira")


def recent_devices(
    transacoes: DataFrame, width: timedelta = timedelta(days=30), uses: DataFrame | None = None
) -> DataFrame:
    """Distinct devices of the account in the ``width`` up to each transaction.

    ``uses`` has the transactions to look in, where those are not ``transacoes`` themselves.

    A device counts from each use until it is used again or ``width`` has passed, so the number of
    devices is a running sum of +1 and -1 steps and no set is built.
    """
    span = width // timedelta(microseconds=1)
    source = transacoes if uses is None else uses
    uses = (
        source.where(F.col("dispositivo").isNotNull())
        .select("conta_id", "dispositivo", F.unix_micros("data_transacao").alias("us"))
        .distinct()
        .withColumn("aparelho", F.concat_ws("|", F.col("conta_id").cast("string"), "dispositivo"))
    )
    ts = F.timestamp_micros(-F.col("us"))
    following = previous_row(uses.withColumn("ts", ts), "aparelho", "ts", "us", ["us"])
    ends = F.least(F.col("us") + span + 1, F.col("prev_us"))
    steps = following.select(
        "conta_id",
        F.inline(
            F.array(
                F.struct(F.timestamp_micros("us").alias("ts"), F.lit(1).alias("passo")),
                F.struct(F.timestamp_micros(ends).alias("ts"), F.lit(-1).alias("passo")),
            )
        ),
    )
    running = running_steps(steps, "conta_id", "ts", "passo", "qtd_dispositivos_30d")
    rows = transacoes.withColumn("us", F.unix_micros("data_transacao"))
    return rows.join(running, ["conta_id", "us"], "left").drop("us").fillna(0, ["qtd_dispositivos_30d"])


def point_in_time(view: FeatureView, requests: DataFrame, features: DataFrame, request_ts: str = "request_ts") -> DataFrame:
    """Requests with the newest feature row of their entity that is not older than the view's TTL."""
    return asof_latest(requests, features, view.entity, request_ts, view.event_timestamp, view.ttl)


def materialize_incremental(
    view: FeatureView, store: DataFrame | None, rows: DataFrame, since: AsOf, until: AsOf = None
) -> DataFrame:
    """Store after adding the view's rows between the last run and ``until``."""
    ts = F.col(view.event_timestamp)
    fresh = rows.where(ts <= moment(until))
    if since is not None:
        fresh = fresh.where(ts > moment(since))
    empty = rows.where(F.lit(False)) if store is None else store
    return upsert(empty, fresh, [view.entity], [view.event_timestamp])
