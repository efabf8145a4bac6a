"""Ordered operators against brute force, with a key that holds most rows and with many ties."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from finlake.operators import features, metrics, ordered

START = datetime(2024, 1, 1)


def sample(seed, n=300, span_hours=30, step_minutes=7):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 1 if rng.random() < 0.6 else rng.randint(2, 6)
        ts = START + timedelta(minutes=step_minutes * rng.randint(0, span_hours * 60 // step_minutes))
        out.append((i, key, ts, float(rng.randint(-50, 5000)), f"c{rng.randint(0, 3)}", f"d{rng.randint(0, 4)}"))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "id long, conta_id long, data_transacao timestamp, valor double, cidade string, dispositivo string")


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("open_start", [False, True])
def test_rolling_stats(spark, seed, open_start):
    data = sample(seed)
    width = timedelta(hours=7)
    df = ordered.rolling_stats(frame(spark, data), "conta_id", "data_transacao", "valor", width, open_start=open_start, slots=12)
    got = {r.id: (r["count"], r["sum"], r["avg"], r["min"], r["max"]) for r in df.collect()}
    for i, key, ts, *_ in data:
        lo = ts - width
        vals = [v for _, k, t, v, *_ in data if k == key and (t > lo if open_start else t >= lo) and t <= ts]
        assert got[i] == (len(vals), sum(vals), pytest.approx(sum(vals) / len(vals)), min(vals), max(vals))


@pytest.mark.parametrize("past_only", [False, True])
def test_other_transactions(spark, past_only):
    data = sample(3)
    df = features.other_transactions_1h(frame(spark, data), past_only)
    got = {r.id: (r.transacoes_ultima_hora, r.valor_acumulado_1h) for r in df.collect()}
    for i, key, ts, value, *_ in data:
        vals = [v for j, k, t, v, *_ in data if k == key and j != i and t > ts - timedelta(hours=1) and (t <= ts or not past_only)]
        assert got[i] == (len(vals), sum(vals))


def test_running_totals_over_many_slots(spark):
    data = sample(4)
    df = frame(spark, data)
    got = {r.seq: (r.n, r.total, r.hi, r.lo) for r in ordered.running_totals(df, ["conta_id"], "id", "valor", slot=16).collect()}
    for i, key, *_ in data:
        vals = [v for j, k, _, v, *_ in data if k == key and j <= i]
        assert got[i] == (len(vals), sum(vals), max(vals), min(vals))


def test_running_metrics_continue_from_a_state(spark):
    df = frame(spark, sample(5)).withColumns({"tipo_transacao": F.lit("PIX"), "status": F.col("cidade")})
    whole = sorted(map(tuple, metrics.running_metrics(df, every=10).collect()))
    first, second = df.where("id < 140"), df.where("id >= 140")
    state = metrics.running_state(first)
    parts = metrics.running_metrics(first, 10).unionByName(metrics.running_metrics(second, 10, start=state))
    assert sorted(map(tuple, parts.collect())) == whole
    assert sorted(map(tuple, metrics.running_state(second, state).collect())) == sorted(map(tuple, metrics.running_state(df).collect()))


def test_previous_row(spark):
    data = sample(6)
    df = ordered.previous_row(frame(spark, data), "conta_id", "data_transacao", "id", ["cidade"])
    got = {r.id: r.prev_cidade for r in df.collect()}
    assert len(got) == len(data)
    for i, key, ts, *_ in data:
        before = [(t, j, c) for j, k, t, _, c, _ in data if k == key and (t, j) < (ts, i)]
        assert got[i] == (max(before)[2] if before else None)


@pytest.mark.parametrize("ttl", [None, timedelta(hours=3)])
def test_asof_latest(spark, ttl):
    data = sample(7)
    probes, values = data[::2], {(k, t): (i, v) for i, k, t, v, *_ in data[1::2]}
    stored = [(k, t, v) for (k, t), (_, v) in values.items()]
    left = frame(spark, probes).select("id", "conta_id", "data_transacao")
    right = spark.createDataFrame(stored, "conta_id long, event_timestamp timestamp, score double")
    got = {r.id: (r.event_timestamp, r.score) for r in ordered.asof_latest(left, right, "conta_id", "data_transacao", "event_timestamp", ttl).collect()}
    for i, key, ts, *_ in probes:
        hits = [(t, v) for k, t, v in stored if k == key and t <= ts and (ttl is None or t >= ts - ttl)]
        assert got[i] == (max(hits) if hits else (None, None))


def test_recent_devices(spark):
    data = sample(8)
    width = timedelta(hours=5)
    got = {r.id: r.qtd_dispositivos_30d for r in features.recent_devices(frame(spark, data), width).collect()}
    for i, key, ts, *_ in data:
        assert got[i] == len({d for _, k, t, _, _, d in data if k == key and ts - width <= t <= ts})


def test_rolling_rows_without_time_are_kept(spark):
    df = frame(spark, [(1, 1, None, 5.0, "c", "d"), (2, 1, START, 7.0, "c", "d")])
    out = {r.id: r["count"] for r in ordered.rolling_stats(df, "conta_id", "data_transacao", "valor", timedelta(days=1)).collect()}
    assert out == {1: None, 2: 1}


def test_hot_key_is_cut_into_slots(spark):
    """One account, evenly spread in time: no (account, slot) group holds more than a small part."""
    n = 20_000
    df = spark.range(n).select(
        F.col("id"), F.lit(1).cast("long").alias("conta_id"),
        F.timestamp_seconds(F.col("id") * 130).alias("data_transacao"), F.lit(1.0).alias("valor"),
    )
    out = ordered.rolling_stats(df, "conta_id", "data_transacao", "valor", timedelta(days=1))
    step = 86_400_000_000 // 360
    biggest = df.groupBy(F.unix_micros("data_transacao") - F.pmod(F.unix_micros("data_transacao"), F.lit(step))).count()
    assert biggest.agg(F.max("count")).head()[0] <= 2
    assert out.agg(F.max("count")).head()[0] == 86_400 // 130 + 1


def test_other_transactions_of_incomplete_and_repeated_rows(spark):
    rows = [
        (1, None, START, 100.0), (2, 1, START, 5.0), (2, 1, START + timedelta(minutes=5), 7.0), (3, 1, START + timedelta(minutes=6), 9.0),
        (None, 1, START, 50.0), (4, 1, None, 60.0), (5, None, START, 70.0),
    ]
    df = frame(spark, [(*r, "c", "d") for r in rows])
    for past_only in (False, True):
        got = features.other_transactions_1h(df, past_only)
        assert sorted(((r.id, r.conta_id, r.valor, r.transacoes_ultima_hora, r.valor_acumulado_1h) for r in got.collect()), key=repr) == sorted([
            (1, None, 100.0, 0, 0.0), (2, 1, 5.0, 0 if past_only else 1, 0.0 if past_only else 9.0), (2, 1, 7.0, 0 if past_only else 1, 0.0 if past_only else 9.0),
            (3, 1, 9.0, 2, 12.0), (None, 1, 50.0, 0, 0.0), (4, 1, 60.0, 0, 0.0), (5, None, 70.0, 0, 0.0),
        ], key=repr)


def test_rolling_stats_keep_the_types_of_a_plain_window(spark):
    df = frame(spark, sample(9, 40)).withColumn("valor", F.col("valor").cast("decimal(19,4)"))
    got = ordered.rolling_stats(df, "conta_id", "data_transacao", "valor", timedelta(days=1))
    after = ordered.totals_after(df, "conta_id", "data_transacao", "valor", timedelta(days=1))
    plain = df.agg(F.sum("valor").alias("sum"), F.avg("valor").alias("avg")).schema
    assert [got.schema[c].dataType for c in ("sum", "avg")] == [f.dataType for f in plain.fields]
    assert after.schema["sum"].dataType == plain["sum"].dataType
    data = {i: (k, t, v) for i, k, t, v, *_ in sample(9, 40)}
    for r in got.collect():
        k, t, _ = data[r.id]
        vals = [v for a, b, v in data.values() if a == k and t - timedelta(days=1) <= b <= t]
        assert float(r["avg"]) == pytest.approx(sum(vals) / len(vals), abs=1e-7)


def test_previous_row_within_one_hour_and_without_key(spark):
    rng = random.Random(3)
    data = [(i, 1, START + timedelta(milliseconds=rng.randrange(3_600_000)), 1.0, f"c{i}", "d") for i in range(400)]
    odd = [(1000, None, START, 1.0, "x", "d"), (1001, None, START, 1.0, "y", "d"), (1002, 1, None, 1.0, "z", "d"), (1003, 1, None, 1.0, "w", "d")]
    got = {r.id: r.prev_cidade for r in ordered.previous_row(frame(spark, data + odd), "conta_id", "data_transacao", "id", ["cidade"]).collect()}
    ordered_rows = sorted(data, key=lambda r: (r[2], r[0]))
    assert got == {r[0]: (ordered_rows[i - 1][4] if i else None) for i, r in enumerate(ordered_rows)} | dict.fromkeys([1000, 1001, 1002, 1003])


def test_asof_latest_never_matches_missing_keys(spark):
    probes = spark.createDataFrame([(1, None, START), (2, 5, START), (3, 5, None), (4, 5, START), (5, 6, START)], "id long, conta_id long, data_transacao timestamp")
    values = spark.createDataFrame([(None, START, 9.0), (5, START - timedelta(days=3), 7.0), (5, None, 1.0)], "conta_id long, event_timestamp timestamp, score double")
    got = {r.id: r.score for r in ordered.asof_latest(probes, values, "conta_id", "data_transacao", "event_timestamp").collect()}
    assert got == {1: None, 2: 7.0, 3: None, 4: 7.0, 5: None}
