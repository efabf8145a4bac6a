"""Distance and devices attached to the fraud features; declared views are met."""

from conftest import SF, rows, tx
from pyspark.sql import functions as F

from finlake.operators import features
from finlake.plans import QUERIES


def test_context_of_one_account_by_hand(spark):
    df = tx(
        spark, (1, 1, "PIX", 1.0, "2024-03-01T10:00:00"), (2, 1, "PIX", 1.0, "2024-03-14T10:00:00"), (3, 1, "PIX", 1.0, "2024-03-14T10:30:00"),
        (4, None, "PIX", 1.0, "2024-03-14T11:00:00"), (5, 2, "PIX", 1.0, "2024-03-01T00:00:00"),
    ).withColumns({
        "latitude": F.when(F.col("id") == 2, 1.0).otherwise(0.0), "longitude": F.lit(0.0),
        "dispositivo": F.when(F.col("id") == 3, "b").when(F.col("id") < 3, "a"),
    })
    got = features.fraud_features(df, "2024-03-14T12:00:00", hours=24)
    assert rows(got.select("transacao_id", F.round("distancia_ultima_transacao_km").cast("int"), "qtd_dispositivos_30d", "is_novo_dispositivo", "transacoes_ultima_hora")) == [
        (2, 111, 1, False, 1), (3, 111, 2, True, 1), (4, None, 0, False, 0)]
    only = features.fraud_features(df.drop("dispositivo"), "2024-03-14T12:00:00", hours=24)
    assert set(features.CONTEXT) & set(only.columns) == {"distancia_ultima_transacao_km"}


def test_builders_conform_to_the_declared_views(spark):
    for name, view in features.CATALOGUE.items():
        built = QUERIES["fraud_features_context" if name == "fraud_features" else name](spark, SF)
        shaped = view.conform(built)
        assert view.check(shaped) == {"missing": [], "extra": []} and shaped.count() == built.count()
    view = features.CATALOGUE["fraud_features"]
    assert view.check(QUERIES["fraud_features_context"](spark, SF)) == {"missing": ["risco_canal"], "extra": ["is_aprovada"]}
    view = features.CATALOGUE["customer_features"]
    assert view.check(QUERIES["customer_features"](spark, SF)) == {"missing": ["tem_emprestimo", "tem_cartao"], "extra": []}
