from datetime import datetime

import pytest
from conftest import rows, tx
from pyspark.sql import functions as F

from finlake.functions.columns import band, divergence_pct
from finlake.operators import enrich, metrics
from finlake.sources import landed


@pytest.mark.parametrize("valor,expected", [(999.99, 0), (1000.0, 0), (1500.0, 1)])
def test_high_value_threshold(spark, valor, expected):
    out = enrich.score_transaction(tx(spark, (1, 1, "PIX", valor, "2024-03-15T10:30:00"))).head()
    assert (out.is_high_value, out.hour, out.day_of_week) == (expected, 10, 4)


@pytest.mark.parametrize("hour,expected", [(8, 0), (9, 1), (12, 1), (18, 1), (19, 0)])
def test_business_hours(spark, hour, expected):
    df = tx(spark, (1, 1, "PIX", 1.0, f"2024-03-14T{hour:02d}:00:00"))
    assert enrich.score_transaction(df).head().is_business_hours == expected
    assert enrich.enrich_transactions(df).head().horario_comercial == expected


def test_weekend_and_day_conventions(spark):
    df = tx(spark, (1, 1, "PIX", 1.0, "2024-03-16T10:00:00"), (2, 1, "PIX", 1.0, "2024-03-14T10:00:00"))
    assert rows(enrich.score_transaction(df).select("id", "is_weekend")) == [(1, 1), (2, 0)]
    assert rows(enrich.enrich_transactions(df).select("id", "dia_semana", "fim_de_semana")) == [(1, 7, 1), (2, 5, 0)]


def test_risk_points_top_out_below_the_alert_threshold(spark):
    df = tx(spark, (1, 1, "PIX", 6000.0, "2024-03-17T04:00:00"))
    assert enrich.score_transaction(df).head().calculated_risk_score == pytest.approx(0.7)
    assert not enrich.score_transaction(df).head().calculated_risk_score > 0.7


def test_messages_keep_malformed_input(spark):
    good = ('{"id": 1, "conta_id": 1001, "tipo_transacao": "PIX", "valor": 500.0, '
            '"data_transacao": "2024-03-15T10:30:00", "status": "APROVADA", "canal": "MOBILE", "score_risco": 0.2}')
    df = spark.createDataFrame([(good,), ("not-json-at-all",), ('{"id": 1}',), (None,)], "value string")
    out = enrich.score_messages(df, "2024-03-15").collect()
    assert [r.malformed for r in out] == [False, True, True, True]
    assert out[1].value == "not-json-at-all" and out[2].value == '{"id": 1}'
    scored = spark.createDataFrame([(out[0].value,)], "v string").select(F.from_json(
        "v", "id long, canal string, hour int, day_of_week int, is_high_value int, is_business_hours int, "
        "is_weekend int, calculated_risk_score double").alias("x")).select("x.*").head()
    assert tuple(scored) == (1, "MOBILE", 10, 4, 0, 1, 0, pytest.approx(0.1))


def test_suspicious_round_values(spark):
    df = tx(spark, (1, 1, "PIX", 10000.0, "2024-03-14T10:00:00"), (2, 1, "PIX", 11000.0, "2024-03-14T10:00:00"),
            (3, 1, "PIX", 11001.0, "2024-03-14T10:00:00"), (4, 1, "PIX", 1.0, "2024-03-14T23:00:00"),
            (5, 1, "PIX", 1.0, "2024-03-14T22:59:00"), (6, 1, "PIX", 5001.0, "2024-03-16T10:00:00"))
    assert rows(df.where(enrich.is_suspicious(df)).select("id")) == [(2,), (4,), (6,)]


def test_bands_and_divergence(spark):
    df = spark.createDataFrame([(800.0,), (799.0,), (600.0,), (399.0,), (None,)], "s double")
    assert [r[0] for r in df.select(enrich.classe_risco(F.col("s"))).collect()] == ["A", "B", "B", "D", "D"]
    strict = band(F.col("s"), [(600, "hi")], "lo", strict=True)
    assert [r[0] for r in df.select(strict).collect()] == ["hi", "hi", "lo", "lo", "lo"]
    pairs = spark.createDataFrame([(0, 0), (0, 10), (1000, 950)], "a long, b long")
    assert [r[0] for r in pairs.select(divergence_pct(F.col("a"), F.col("b"))).collect()] == [0.0, 100.0, 5.0]


def test_normalize_types(spark):
    df = spark.createDataFrame(
        [("2024-01-01 10:00:00", "12.5", True, None), ("bad", "x", None, {"a": 1})],
        "data_transacao string, valor string, aprovada boolean, detalhes map<string,int>",
    )
    assert [tuple(r) for r in enrich.normalize_types(df).collect()] == [
        (datetime(2024, 1, 1, 10), 12.5, 1, None), (None, 0.0, 0, '{"a":1}')]


def test_dead_letters(spark):
    df = spark.createDataFrame([("a", "2024-01-01", "PIX", 1.0), ("b", None, "PIX", 1.0), ("c", "x", "PIX", None)],
                               "transaction_id string, timestamp string, tipo string, valor double")
    good, bad = landed.split_dlq(df)
    assert rows(good.select("transaction_id")) == [("a",)]
    assert rows(bad.select("transaction_id")) == [("b",), ("c",)]


def test_market_payloads(spark):
    series = spark.createDataFrame([("CDI", '[{"data":"1","valor":"1.5"},{"data":"2","valor":"2.25"}]'),
                                    ("SELIC", "[]"), ("OUTRA", '[{"data":"1","valor":"1"}]')],
                                   "indicador string, payload string")
    out = landed.market_indicators(series, "2024-01-01").collect()
    assert [(r.indicador, float(r.valor), r.labels) for r in out] == [
        ("CDI", 2.25, {"source": "bcb_api", "series_id": "4389"})]
    bonds = spark.createDataFrame([('{"nmTitulo":"Tesouro Selic","puCompraManha":10.5,"taxaCompraManha":12.5}',),
                                   ('{"nmTitulo":"X","puCompraManha":0}',), ('{"puCompraManha":3}',)], "payload string")
    got = rows(landed.bond_prices(bonds, "2024-01-01").selectExpr(
        "ativo_id", "tipo_investimento", "double(preco_unitario_venda)", "double(taxa_indicativa)"))
    assert got == [("", "TESOURO_OUTROS", 0.0, 0.0), ("Tesouro Selic", "TESOURO_SELIC", 0.0, 0.125)]


def test_daily_windows_start_at_midnight(spark):
    df = tx(spark, (1, 1, "PIX", 1.0, "2024-03-14T00:00:00"), (2, 1, "PIX", 2.0, "2024-03-13T23:59:59"),
            (3, 1, "PIX", 3.0, "2024-03-08T00:00:00"), (4, 1, "PIX", 4.0, "2024-03-07T23:00:00"))
    out = metrics.aggregate_windows(df, (1, 7), "2024-03-15")
    got = rows(out.selectExpr("janela_dias", "string(to_date(data_ref))", "total_transacoes"))
    assert got == [(1, "2024-03-14", 1), (7, "2024-03-08", 1), (7, "2024-03-13", 1), (7, "2024-03-14", 1)]


def test_empty_input(spark):
    df = tx(spark, (1, 1, "PIX", 1.0, "2024-03-14T00:00:00")).where("false")
    live = metrics.live_transaction_metrics(df, 60, "2024-03-15").head()
    assert live.transacoes_por_canal == {} and live.taxa_aprovacao == 0.0
    assert metrics.running_metrics(df).count() == 0


def test_behaviour_counts_kinds_of_accounts_and_owners(spark):
    from finlake.operators import profile

    df = tx(
        spark, (1, 1, "PIX", 10.0, "2024-03-10T10:00:00"), (2, 1, "TED", 20.0, "2024-03-14T10:00:00"), (3, 2, "PIX", 5.0, "2024-03-14T10:00:00"),
        (4, None, "PIX", 1.0, "2024-03-14T10:00:00"), (5, None, None, 1.0, "2024-03-14T10:00:00"),
    )
    columns = ["transacoes_30d", "volume_30d", "qtd_tipos_transacao", "qtd_canais_utilizados"]
    got = profile.account_behaviour(df, "2024-03-15").select("conta_id", *columns)
    assert rows(got) == [(1, 2, 30.0, 2, 1), (2, 1, 5.0, 1, 1), (None, 2, 2.0, 1, 1)]
    owners = spark.createDataFrame([(1, 7), (2, 7), (2, 7), (2, None)], "id long, cliente_id long")
    got = profile.customer_behaviour(owners, df, "2024-03-15").select("cliente_id", *columns)
    assert rows(got) == [(7, 4, 40.0, 2, 1), (None, 1, 5.0, 1, 1)]
