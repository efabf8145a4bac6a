"""Keyed tables, change data, watermarks, retention, sinks."""

import random
from datetime import datetime

import pytest
from conftest import rows, tx
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake import schemas, sinks
from finlake.operators.latest import keep_latest, latest_by_key, upsert
from finlake.session import checkpoint_path
from finlake.sources import cdc, incremental, readers

ROW = "id long, nome string"


def parsed(spark, *values):
    return cdc.parse_cdc(spark.createDataFrame([(v,) for v in values], "value string"), ROW)


def test_cdc_operations(spark):
    out = parsed(
        spark,
        '{"op":"c","ts_ms":1722830400000,"after":{"id":1,"nome":"a"}}',
        '{"op":"u","source":{"ts_ms":1722830400500},"after":{"id":2,"nome":"b"}}',
        '{"op":"d","ts_ms":1722830400000,"before":{"id":3,"nome":"c"},"after":null}',
        '{"after":{"id":4,"nome":"d"}}',
    )
    assert rows(out) == [
        (1, "a", "c", "2024-08-05T04:00:00+00:00", False),
        (2, "b", "u", "2024-08-05T04:00:00.500000+00:00", False),
        (3, "c", "d", "2024-08-05T04:00:00+00:00", True),
        (4, "d", "u", None, False),
    ]


@pytest.mark.parametrize("bad", [None, "", "not json", '{"op":"r","after":null}', '{"op":"u","before":{"id":1}}', "null"])
def test_cdc_drops_messages_without_a_row(spark, bad):
    assert parsed(spark, bad).count() == 0


def test_apply_cdc_is_idempotent(spark):
    rng = random.Random(3)
    log = [(rng.randint(1, 9), f"v{i}", rng.choice("cud"), f"2024-01-01T00:00:{i:02d}+00:00") for i in range(60)]
    log = [(k, v, op, ts, op == "d") for k, v, op, ts in log]
    schema = "id long, nome string, _cdc_op string, _cdc_ts string, _cdc_deleted boolean"
    once = cdc.apply_cdc(spark.createDataFrame(log, schema), ["id"])
    twice = cdc.apply_cdc(spark.createDataFrame(log + rng.sample(log, 30), schema).repartition(7), ["id"])
    expected = {}
    for k, v, op, ts, gone in log:
        expected[k] = None if gone else (k, v)
    assert rows(once) == rows(twice) == sorted((r for r in expected.values() if r), key=repr)


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k int, v string, o int")
    assert rows(upsert(target, updates, ["k"], ["o"])) == [(1, "a"), (2, "y"), (3, "z")]
    assert rows(upsert(upsert(target, updates, ["k"], ["o"]), updates, ["k"], ["o"])) == [(1, "a"), (2, "y"), (3, "z")]


def test_latest_by_key_breaks_ties_the_same_way(spark):
    data = [(1, i % 3, f"v{i}") for i in range(30)]
    picks = {tuple(latest_by_key(spark.createDataFrame(data, "k int, o int, v string").repartition(n), ["k"], ["o"]).head()) for n in (1, 3, 8)}
    assert len(picks) == 1


def test_keep_latest_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("m", i) for i in range(105)], "metrica string, ts int")
    kept = keep_latest(df, ["metrica"], "ts")
    assert [r.ts for r in kept.orderBy("ts").collect()] == list(range(5, 105))
    assert "WindowGroupLimit" in explain(kept)


def explain(df):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_watermark_round(spark, tmp_path):
    path = str(tmp_path / "wm")
    schema = "id int, data_atualizacao timestamp"
    day = [datetime(2024, 1, d) for d in (1, 2, 3)]
    source = spark.createDataFrame([(1, day[0]), (2, day[1])], schema)
    assert incremental.read_watermark(spark, path) is None
    first = incremental.incremental_extract(source, incremental.read_watermark(spark, path))
    assert first.count() == 2
    incremental.write_watermark(incremental.next_watermark(first), path)
    mark = incremental.read_watermark(spark, path)
    assert mark == day[1]
    assert incremental.incremental_extract(source, mark).count() == 0
    incremental.write_watermark(incremental.next_watermark(incremental.incremental_extract(source, mark)), path)
    assert incremental.read_watermark(spark, path) == day[1]
    grown = source.union(spark.createDataFrame([(3, day[2])], schema))
    assert rows(incremental.incremental_extract(grown, mark).select("id")) == [(3,)]
    assert incremental.next_watermark(spark.range(3)).count() == 0


def test_bronze_keeps_earlier_loads_of_the_day(spark, tmp_path):
    root = str(tmp_path)
    for batch in (0, 1, 1):
        sinks.write_bronze(spark.range(batch + 2), root, "postgres", "contas", batch, "2024-01-05")
    stored = spark.read.parquet(f"{root}/postgres/contas")
    assert rows(stored.groupBy("batch_id").count()) == [(0, 2), (1, 3)]
    assert {str(r[0]) for r in stored.select("ingest_date").distinct().collect()} == {"2024-01-05"}


def test_keyed_sink_and_compaction(spark, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path / "c")
    for batch, data in enumerate([[(1, "a"), (2, "b")], [(2, "x")], [(3, "z"), (1, "q")]]):
        sinks.write_batch(spark.createDataFrame(data, "k int, v string"), path, batch)
    expected = [(1, "q"), (2, "x"), (3, "z")]
    assert rows(sinks.read_current(spark, path, ["k"])) == expected
    sinks.compact(spark, path, ["k"], out)
    assert rows(sinks.read_current(spark, out, ["k"])) == expected


def test_purge(spark):
    df = spark.createDataFrame([(1, datetime(2020, 1, 1)), (2, datetime(2024, 1, 1)), (3, None)], "id int, data_atualizacao timestamp")
    assert rows(sinks.purge_expired(df, 1825, "2025-06-01").select("id")) == [(2,), (3,)]
    assert rows(sinks.purge_counts({"transacao": df}, "2025-06-01")) == [
        ("auditoria", 0), ("cliente_pf", 0), ("cliente_pj", 0), ("transacao", 1)]


def test_sync(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01 09:30:00", "7"), (2, "2024-01-01 08:00:00", "x")], "id int, data_atualizacao string, saldo string")
    df = df.withColumn("data_atualizacao", F.col("data_atualizacao").cast("timestamp"))
    out = str(tmp_path / "s")
    sinks.sync_table(df, lambda d: d.write.mode("append").parquet(out), as_of="2024-01-01 10:00:00")
    assert rows(spark.read.parquet(out).select("id", "saldo")) == [(1, 7.0)]

    def broken():
        raise OSError("no target")

    status = sinks.sync_all({"a": lambda: None, "b": broken, "c": lambda: None})
    assert [(s["tabela"], s["ok"]) for s in status] == [("a", True), ("b", False), ("c", True)]


@pytest.mark.parametrize("name,expected", [
    ("bigint", T.LongType()), ("integer", T.IntegerType()), ("smallint", T.ShortType()), ("decimal", T.DecimalType(18, 4)),
    ("numeric", T.DecimalType(18, 4)), ("real", T.FloatType()), ("double precision", T.DoubleType()), ("varchar", T.StringType()),
    ("text", T.StringType()), ("timestamp", T.TimestampType()), ("timestamp with time zone", T.TimestampType()),
    ("date", T.DateType()), ("boolean", T.ByteType()), ("jsonb", T.StringType()), ("uuid", T.StringType())])
def test_type_map(name, expected):
    assert schemas.target_type(name) == expected


def test_transaction_schema():
    assert len(schemas.TRANSACAO) == 19
    assert schemas.TRANSACAO["valor"].dataType == T.DecimalType(19, 4)


def test_reports_and_dead_letters(spark, tmp_path):
    path = str(tmp_path / "r")
    report = spark.createDataFrame([("contas", 1)], "tabela string, divergencias int")
    for stamp in ("2024-01-01 10:00:00", "2024-01-02 10:00:00"):
        sinks.save_report(report, path, stamp)
    assert rows(spark.read.json(f"{path}/latest").select("timestamp")) == [("2024-01-02T10:00:00Z",)]
    assert spark.read.json(f"{path}/history").count() == 2
    half = str(tmp_path / "half")
    batch = spark.createDataFrame([(i,) for i in range(5)] + [(None,)], "id long")
    for _ in range(2):  # a repeated batch replaces itself
        sinks.write_dead_letters(batch, F.col("id") > 2, half, 0)
    sinks.write_dead_letters(batch, F.col("id") > 3, half, 1)
    assert rows(sinks.read_half(spark, half).where("batch_id = 0").select("id")) == [(0,), (1,), (2,)]
    assert sinks.read_half(spark, half, rejected=True).count() == 3 + 2 and sinks.read_half(spark, half).count() == 3 + 4


def test_sources(spark, tmp_path):
    df = tx(spark, (1, 1, "PIX", 5.5, "2024-03-14T10:00:00"))
    path = str(tmp_path / "j")
    df.write.json(path)
    back = readers.read_json(spark, path)
    assert back.schema == schemas.TRANSACAO and back.head().valor == df.selectExpr("CAST(valor AS DECIMAL(19,4))").head()[0]
    raw = df.select(F.to_json(F.struct("*")).alias("value"))
    assert readers.parse_events(raw).select("id", "canal").head() == (1, "MOBILE")
    registry = readers.SourceRegistry({"contas": lambda s: s.range(3)})
    registry.declare("clientes", lambda s: s.range(2))
    assert registry.register_views(spark) == ["clientes", "contas"]
    assert spark.sql("SELECT count(*) FROM contas").head()[0] == 3
    with pytest.raises(KeyError):
        registry.read(spark, "outra")
    spark.range(1).write.parquet(str(tmp_path / "f"))
    with pytest.raises(ValueError):
        readers.read_feature_source(spark, str(tmp_path / "f"))
    with pytest.raises(ValueError):
        readers.read_jdbc(spark, "jdbc:x", "t", partition_column="id")


def test_checkpoints_lie_below_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_path(spark, "q").startswith(root.rstrip("/"))
