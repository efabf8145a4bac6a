"""Sinks that hold each batch and each document once: repeated, failed and aborted batches, restarts."""

import os

import pyarrow as pa
import pytest
from conftest import SF, rows, tx
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from finlake import sinks
from finlake.sources import readers
from finlake.sources.testdata import eventos
from finlake.streaming import committed, runner

SCHEMA = "id long, valor double"


def part(*items):
    return pa.RecordBatch.from_pylist([{"id": i, "valor": v} for i, v in items], pa.schema([("id", pa.int64()), ("valor", pa.float64())]))


def test_a_batch_handed_over_twice_counts_once(spark, tmp_path):
    path, writer = str(tmp_path / "t"), committed.CommittedWriter(str(tmp_path / "t"))
    assert committed.read_committed(spark, path, SCHEMA).count() == 0
    first = [writer.write(iter([part((1, 1.0), (2, 2.0))])), writer.write(iter([part()])), writer.write(iter([part((3, 3.0))]))]
    assert first[1] is None
    assert committed.read_committed(spark, path, SCHEMA).count() == 0  # written, not committed
    writer.commit(first, 0)
    writer.commit(first, 0)
    again = [writer.write(iter([part((1, 1.0)), part((2, 2.0), (3, 3.0))]))]
    writer.commit(again, 0)
    writer.commit([writer.write(iter([part((3, 30.0))]))], 1)
    assert rows(committed.read_committed(spark, path, SCHEMA)) == [(1, 1.0, 0), (2, 2.0, 0), (3, 3.0, 0), (3, 30.0, 1)]
    assert rows(committed.read_documents(spark, path, SCHEMA, "id")) == [(1, 1.0), (2, 2.0), (3, 30.0)]
    assert len(os.listdir(f"{path}/data")) == 2


def test_an_aborted_batch_leaves_nothing(spark, tmp_path):
    path, writer = str(tmp_path / "t"), committed.CommittedWriter(f"file://{tmp_path}/t")
    writer.commit([writer.write(iter([part((1, 1.0))]))], 0)
    writer.abort([writer.write(iter([part((2, 2.0))])), None], 1)
    assert len(os.listdir(f"{path}/data")) == 1
    writer.commit([], 1)
    assert rows(committed.read_committed(spark, path, SCHEMA)) == [(1, 1.0, 0)]


def test_a_stream_that_fails_midway_goes_on(spark, tmp_path):
    data, source, out = eventos(spark, SF), str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        data.where(f"id % 3 = {i}").coalesce(1).write.parquet(f"{source}/{i}")

    def run(broken):
        stream = readers.read_event_stream(spark, "parquet", data.schema, path=f"{source}/*", maxFilesPerTrigger="1").repartition(4)
        if broken:  # fails in the second batch, after some tasks have written
            stream = stream.where(F.when((F.col("id") == 901) & (F.col("id") % 3 == 1), F.raise_error("broken").cast("boolean")).otherwise(True))
        committed.committed_stream(stream, out, "c", trigger=None, checkpoint=str(tmp_path / "cp")).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(True)
    partly = committed.read_committed(spark, out, data.schema)
    assert 0 < partly.count() < data.count()
    run(False)
    run(False)
    whole = committed.read_committed(spark, out, data.schema)
    assert rows(whole.drop("batch_id")) == rows(data)
    assert rows(committed.read_documents(spark, out, data.schema, "id")) == rows(data)


def test_jdbc_batches_are_staged_and_replaced(spark, tmp_path, monkeypatch):
    """The staging write and the transaction stand in for a database: none may be started here."""
    tables, failing = {}, []

    def write(df, url, table, mode, **options):
        assert mode == "overwrite" and url == "jdbc:x"
        tables[table] = [tuple(r) for r in df.collect()]
        if failing:
            raise RuntimeError("lost")

    def transaction(statements):
        assert statements[0].startswith("DELETE FROM t WHERE batch_id = ") and statements[1] == "INSERT INTO t SELECT * FROM t_lote"
        batch_id = int(statements[0].rsplit(" ", 1)[1])
        tables["t"] = [r for r in tables.get("t", []) if r[-1] != batch_id] + tables["t_lote"]

    monkeypatch.setattr(runner, "write_jdbc", write)
    put = runner.jdbc_batches("jdbc:x", "t", transaction)
    one, two = (spark.createDataFrame(x, SCHEMA) for x in ([(1, 1.0), (2, 2.0)], [(3, 3.0)]))
    put(one, 0)
    put(one, 0)
    failing.append(1)
    with pytest.raises(RuntimeError):
        put(two, 1)
    assert sorted(tables["t"]) == [(1, 1.0, 0), (2, 2.0, 0)]
    failing.clear()
    put(two, 1)
    assert sorted(tables["t"]) == [(1, 1.0, 0), (2, 2.0, 0), (3, 3.0, 1)]


def test_documents_have_an_id_that_follows_from_the_row(spark):
    batch = tx(spark, (1, 1, "PIX", 1.0, "2024-03-14T10:00:00"), (1, 1, "PIX", 2.0, "2024-03-14T11:00:00"), (None, 2, "PIX", 3.0, "2024-03-14T10:00:00"))
    once, again = (rows(runner.documents(batch, "id", ["data_transacao"]).select("id", "valor")) for _ in range(2))
    assert once == again and len(once) == 2 and ("1", 2.0) in once
    assert sum(len(i) == 64 for i, _ in once) == 1


def test_connector_batches_name_the_key(spark, tmp_path):
    seen = {}

    class Writer:
        def __getattr__(self, name):
            def step(*args, **options):
                seen[name] = args or options
                return self

            return step

    class Batch:
        write = Writer()

    put = runner.connector_batches("es", "id", **{"es.nodes": "n"})
    original = runner.documents
    try:
        runner.documents = lambda batch, key, order: batch
        put(Batch(), 3)
    finally:
        runner.documents = original
    assert seen["format"] == ("es",) and seen["options"] == {"es.mapping.id": "id", "es.nodes": "n"} and seen["mode"] == ("append",)
    assert sinks.write_batch is runner.write_batch
