import pytest
from conftest import rows, tx
from pyspark.sql import functions as F

from finlake.functions.extras import Extras
from finlake.operators import alerts


def burst(n, value=100.0, kind="PIX", account=1, city="C1"):
    return [(i, account, kind, value, f"2024-03-14T10:00:{i:02d}", city) for i in range(n)]


def test_high_value_at_night(spark):
    df = tx(spark, (1, 1, "PIX", 10000.0, "2024-03-14T23:00:00"), (2, 1, "PIX", 10000.01, "2024-03-14T23:00:00"),
            (3, 1, "PIX", 20000.0, "2024-03-14T22:59:00"), (4, 1, "TED", 20000.0, "2024-03-14T05:59:00"),
            (5, 1, "TED", 20000.0, "2024-03-14T06:00:00"))
    out = alerts.high_value_at_night(df)
    assert rows(out.select("alerta_id", "recomendacao")) == [
        ("ALT-R1-2", "BLOQUEAR_E_VERIFICAR"), ("ALT-R1-4", "BLOQUEAR_E_VERIFICAR")]
    assert out.where("transacao_id = 2").head().descricao == "Transação de alto valor (R$ 10000.0100) em horário noturno"


@pytest.mark.parametrize("n,expected", [(2, []), (3, [(0.6, "MEDIO")]), (5, [(0.8, "ALTO")]), (10, [(0.95, "CRITICO")])])
def test_rapid_transactions(spark, n, expected):
    out = alerts.rapid_transactions(tx(spark, *burst(n)))
    assert rows(out.select("score_fraude", "nivel_risco")) == expected
    if expected:
        assert out.head().alerta_id == "ALT-R2-1-2024-03-14 10:00:00.000"


def test_rapid_transactions_ignores_rejected(spark):
    data = [(i, 1, "PIX", 1.0, f"2024-03-14T10:00:{i:02d}", "C1", "REJEITADA") for i in range(9)]
    assert alerts.rapid_transactions(tx(spark, *data)).count() == 0


@pytest.mark.parametrize("total,expected", [
    (20000.0, None), (20001.0, (0.75, "MEDIO")), (30001.0, (0.9, "ALTO")), (50001.0, (0.98, "CRITICO"))])
def test_value_build_up(spark, total, expected):
    df = tx(spark, (1, 1, "PIX", total - 1, "2024-03-14T10:00:10"), (2, 1, "PIX", 1.0, "2024-03-14T10:04:00"))
    out = alerts.value_build_up(df).where(f"valor_transacao = {total}").select("score_fraude", "nivel_risco")
    assert set(rows(out)) == ({expected} if expected else set())
    # Both rows share only the window that starts with the first one.
    assert out.count() == (1 if expected else 0)


def test_pix_rules(spark):
    df = tx(spark, (1, 1, "PIX", 50000.0, "2024-03-14T10:00:00"), (2, 1, "PIX", 50000.5, "2024-03-14T10:00:00"),
            (3, 1, "TED", 90000.0, "2024-03-14T10:00:00"), (4, 1, "PIX", 5001.0, "2024-03-14T02:00:00"),
            (5, 1, "PIX", 5000.0, "2024-03-14T02:00:00"))
    assert rows(alerts.pix_high_value(df).select("transacao_id")) == [(2,)]
    night = alerts.pix_odd_hours(df)
    assert rows(night.select("transacao_id", "score_risco", "descricao")) == [(4, 0.7, "PIX R$ 5001.0000 as 2h")]
    unknown = alerts.pix_odd_hours(df.drop("score_risco").selectExpr("*", "CAST(NULL AS DOUBLE) AS score_risco"))
    assert unknown.head().score_risco is None


@pytest.mark.parametrize("n,expected", [(4, 0), (5, 1)])
def test_pix_sweep(spark, n, expected):
    out = alerts.pix_sweep(tx(spark, *burst(n)))
    assert out.count() == expected


def test_many_cities_counts_each_city_once(spark):
    df = tx(spark, *[(i, 1, "PIX", 10.0, f"2024-03-14T10:{i:02d}:00", c) for i, c in enumerate(["A", "A", "B", "C"])],
            *[(9 + i, 2, "PIX", 10.0, f"2024-03-14T10:{i:02d}:00", c) for i, c in enumerate(["A", "A", "B"])])
    out = alerts.pix_many_cities(df)
    assert {r.conta_id for r in out.collect()} == {1}
    assert {(r.descricao, float(r.valor_transacao)) for r in out.collect()} == {("3 cidades em 1h", 40.0)}
    assert out.count() == 12


def test_location_change(spark):
    df = tx(spark, (1, 1, "PIX", 1.0, "2024-03-14T10:00:00", "A"), (2, 1, "PIX", 1.0, "2024-03-14T10:30:00", "A"),
            (3, 1, "PIX", 1.0, "2024-03-16T10:00:00", "B"), (4, 2, "PIX", 1.0, "2024-03-16T10:00:00", "A"))
    assert rows(alerts.location_change(df).select("transacao_id", "cidade_anterior", "cidade")) == [(3, "A", "B")]


def test_high_risk_needs_a_lower_threshold(spark):
    df = tx(spark, (1, 7, "PIX", 6000.0, "2024-03-17T04:00:00"))
    assert alerts.high_risk(df).count() == 0
    both = alerts.risk_alerts(df, 0.6, "2024-03-18")
    assert rows(both.select("alert_type", "recommended_action")) == [
        ("HIGH_RISK_TRANSACTION", "REVIEW_MANUAL"), ("SUSPICIOUS_PATTERN", "INVESTIGATE")]
    assert rows(alerts.flagged_accounts(both)) == [(7,)]


def test_measures_may_not_take_a_column_of_the_result(spark):
    df = tx(spark, (1, 1, "PIX", 20000.0, "2024-03-14T02:00:00"))
    with pytest.raises(ValueError, match="valor_transacao"):
        alerts.high_value_at_night(df, extras=Extras({"valor_transacao": F.lit(1)}))


def test_a_condition_that_is_null_leaves_the_row_out(spark):
    df = tx(spark, (1, 1, "PIX", 20000.0, "2024-03-14T02:00:00", None), (2, 1, "PIX", 20000.0, "2024-03-14T03:00:00", "A"), (3, 1, "PIX", 20000.0, "2024-03-14T04:00:00", "B"))
    extras = Extras({"dobro": F.col("valor") * 2}, F.col("cidade") == "A")
    assert rows(alerts.high_value_at_night(df, extras=extras).select("transacao_id", "dobro")) == [(2, 40000.0)]
    # A transaction that raises no alert is still the one before.
    back = Extras({"dobro": F.col("valor") * 2}, F.col("cidade") == "B")
    assert rows(alerts.location_change(df, extras=back).select("transacao_id", "cidade_anterior", "dobro")) == [(3, "A", 40000.0)]
    assert alerts.location_change(df, extras=Extras(where=F.col("cidade") == "A")).count() == 0
