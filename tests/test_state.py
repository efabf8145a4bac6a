"""Stream operators with state: equal to the table, over restarts, repeated and late rows, and with state that expires."""

import pytest
from conftest import SF, rows, tx
from pyspark.sql import functions as F

from finlake.operators import alerts, metrics, windows
from finlake.sources import readers
from finlake.sources.testdata import eventos
from finlake.streaming import pipelines, runner, state


class Landing:
    """A folder of files that a stream reads one at a time, and the result of the query over it."""

    def __init__(self, spark, path, build, watermark=None):
        self.spark, self.path, self.build, self.watermark, self.files = spark, str(path), build, watermark, 0

    def land(self, *parts):
        for part in parts:
            self.schema = part.schema
            part.coalesce(1).write.parquet(f"{self.path}/in/{self.files:03d}")
            self.files += 1

    def run(self):
        source = readers.read_event_stream(
            self.spark, "parquet", self.schema, self.watermark, path=f"{self.path}/in/*", maxFilesPerTrigger="1")
        query = runner.run_stream(
            self.build(source), runner.parquet_batches(f"{self.path}/out"), "q", trigger=None, checkpoint=f"{self.path}/cp")
        query.awaitTermination()
        return query

    def result(self):
        return self.spark.read.parquet(f"{self.path}/out").drop("batch_id")


def by_id(df, *cuts):
    edges = [None, *cuts, None]
    return [df.where(F.lit(True) if a is None else F.col("id") >= a).where(F.lit(True) if b is None else F.col("id") < b) for a, b in zip(edges, edges[1:])]


def test_every_nth_emission_over_restarts(spark, tmp_path):
    data = eventos(spark, SF).withColumn("valor", F.when(F.col("id") % 7 != 0, F.col("valor")))
    first, second, third, fourth = by_id(data, 200, 430, 800)
    landing = Landing(spark, tmp_path, lambda s: state.running_metrics_stream(s, every=20))
    landing.land(first, second)
    landing.run()
    part = metrics.running_metrics(first.unionByName(second), every=20)
    assert rows(landing.result()) == rows(part) and part.count() > 0
    landing.land(third, fourth)  # a new query goes on from the checkpoint
    landing.run()
    expected = metrics.running_metrics(data, every=20)
    assert landing.result().columns == expected.columns
    assert rows(landing.result()) == rows(expected) and expected.count() > part.count()


def test_running_figures_of_keys_without_values(spark, tmp_path):
    data = tx(spark, *[(i, 1, "PIX", None, "2024-03-14T10:00:00") for i in range(1, 6)]).withColumn("valor", F.col("valor").cast("double"))
    landing = Landing(spark, tmp_path, lambda s: state.running_metrics_stream(s, every=2))
    landing.land(data.where("id <= 3"), data.where("id > 3"), data.where("false"))
    landing.run()
    assert rows(landing.result()) == rows(metrics.running_metrics(data, every=2))


def flush(spark):
    """Two far rows: the first moves the watermark, the second lets a batch run behind it."""
    return [tx(spark, (10**9 + i, -1 - i, "PIX", 1.0, f"2024-06-0{i + 1}T00:00:00")) for i in range(2)]


def test_location_changes_equal_the_table(spark, tmp_path):
    data = eventos(spark, SF)
    edges = ["2023-01-01", "2024-01-09", "2024-01-20", "2025-01-01"]
    parts = [data.where(f"data_transacao >= '{a}' AND data_transacao < '{b}'") for a, b in zip(edges, edges[1:])]
    landing = Landing(spark, tmp_path, state.location_change_stream, "5 seconds")
    landing.land(parts[0], parts[1])
    landing.run()
    landing.land(parts[2], *flush(spark))
    landing.run()
    expected = rows(alerts.location_change(data))
    assert landing.result().columns == alerts.location_change(data).columns
    assert rows(landing.result()) == expected and len(expected) > 10


def test_location_rows_out_of_order_and_late(spark, tmp_path):
    def at(i, minute, city, account=1):
        return (i, account, "PIX", 1.0, f"2024-03-14T10:{minute:02d}:00", city)

    landing = Landing(spark, tmp_path, state.location_change_stream, "10 minutes")
    landing.land(
        tx(spark, at(1, 10, "A"), at(2, 20, "C"), at(8, 21, None, 2)),
        tx(spark, at(3, 15, "B"), at(4, 20, "C")),  # out of order but within the watermark; an equal time and city
        tx(spark, at(5, 50, "A")),
        tx(spark, at(6, 55, "A")),
        tx(spark, at(7, 12, "X")),  # behind the watermark: dropped
        *flush(spark),
    )
    landing.run()
    got = landing.result().select("transacao_id", "cidade_anterior", "cidade")
    assert rows(got) == [(2, "B", "C"), (3, "A", "B"), (5, "C", "A")]


def test_location_state_expires(spark, tmp_path):
    hour = 3_600_000
    landing = Landing(spark, tmp_path, lambda s: state.location_change_stream(s, hour), "1 minute")
    landing.land(*[
        tx(spark, (i, i, "PIX", 1.0, f"2024-03-14T{i:02d}:00:00", "A"), (100 + i, 77, "PIX", 1.0, f"2024-03-14T{i:02d}:{(i % 2) * 50:02d}:00", f"C{i}"))
        for i in range(12)
    ])
    query = landing.run()
    # Account 77 moves at 0:00, 1:50, 2:00, 3:50, 4:00 ...: only those within the hour count.
    assert rows(landing.result().select("transacao_id")) == [(102,), (104,), (106,), (108,), (110,)]
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(sizes) <= 12 and sizes[-1] <= sizes[4]


def test_accounts_are_flagged_once_for_ever(spark, tmp_path):
    data = eventos(spark, SF)
    landing = Landing(spark, tmp_path, lambda s: pipelines.first_flagged_stream(alerts.risk_alerts(s, 0.3, "2024-02-01")), "5 seconds")
    landing.land(*by_id(data, 500))
    landing.run()
    expected = alerts.flagged_accounts(alerts.risk_alerts(data, 0.3, "2024-02-01"))
    assert rows(landing.result()) == rows(expected) and landing.result().count() == landing.result().distinct().count()


def test_accounts_are_flagged_once_in_a_horizon(spark, tmp_path):
    def day(d, *accounts):
        return tx(spark, *[(100 * d + a, a, "PIX", 90000.0, f"2024-03-{d:02d}T02:00:00") for a in accounts])

    landing = Landing(spark, tmp_path, lambda s: state.flagged_account_stream(s, "1 day", 0.3, "2024-04-01"))
    landing.land(*[day(d, 1 if d < 3 or d > 9 else 2, 1000 + d, 1000 + d) for d in range(1, 13)])
    query = landing.run()
    flagged = landing.result().select("account_id", F.dayofmonth("data_transacao").alias("d"))
    assert sorted(r["d"] for r in flagged.where("account_id = 1").collect()) in ([1, 10], [1, 10, 12])
    assert rows(flagged.where("account_id > 1000")) == [(1000 + d, d) for d in range(1, 13)]
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(sizes) <= 8


@pytest.mark.parametrize("build", [state.running_metrics_stream, state.location_change_stream])
def test_plans_keep_state_in_spark(spark, tmp_path, build):
    landing = Landing(spark, tmp_path, build, "5 seconds")
    landing.land(eventos(spark, SF))
    query = landing.run()
    names = {s["operatorName"] for p in query.recentProgress for s in p["stateOperators"]}
    assert names == {"transformWithStateInPySparkExec"} or names == {"transformWithStateInPandasExec"}


SLIDING = {
    "w2": lambda df: windows.sliding_volume(df),
    "w3": lambda df: windows.sliding_channel(df, "1 hour", "2 minutes"),
    "w4": lambda df: windows.sliding_approval(df),
    "r8": lambda df: alerts.pix_many_cities(df, "12 hours", "1 hour", 2),
}


@pytest.mark.parametrize("name", list(SLIDING))
def test_sliding_windows_are_chained_panes(spark, tmp_path, name):
    data = eventos(spark, SF).where("data_transacao < '2024-01-05'")
    landing = Landing(spark, tmp_path, SLIDING[name], "1 second")
    # Each chained aggregation emits a batch after the one before it.
    far = [tx(spark, (10**9 + i, -1 - i, "PIX", 1.0, f"2024-06-0{i + 1}T00:00:00", "FAR")) for i in range(4)]
    landing.land(data, *far)
    query = landing.run()
    expected = SLIDING[name](data)
    got = landing.result()
    ends = "window_end" if "window_end" in got.columns else "timestamp_alerta"
    assert rows(got.where(F.col(ends) < "2024-03-01").select(*expected.columns)) == rows(expected) and expected.count() > 0
    operators = [p["stateOperators"] for p in query.recentProgress if p["stateOperators"]]
    assert all(len(x) >= 2 for x in operators)
    # A row enters one pane of the first aggregation, not the thirty windows that hold it.
    first = max(x[-1]["numRowsUpdated"] for x in operators)
    assert first <= data.count()
