"""Exact and line deduplication, minimal perfect hash, components."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from finlake.llm import minimal_hash
from finlake.llm.components import components
from finlake.llm.exact_dedup import exact_dedup
from finlake.llm.line_dedup import LineRuns, drop_repeated_lines
from finlake.llm.queries import ORACLE, QUERIES

from .helpers import ODD, SF, docs_of, oracle, records


def test_minimal_hash_fills_every_slot_and_rejects_others():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    words = minimal_hash.words_of(digests)
    sizes, bits = minimal_hash.build(words)
    place = minimal_hash.slots(words, sizes, bits)
    assert sorted(place) == list(range(5000))
    others = minimal_hash.words_of([hashlib.sha256(f"x{i}".encode()).digest() for i in range(1000)])
    at = minimal_hash.slots(others, sizes, bits)
    stored = np.empty_like(words)
    stored[place] = words
    hit = at >= 0
    assert not (stored[at[hit]] == others[hit]).all(axis=1).any()
    assert minimal_hash.build(words[:0])[0] == []


def test_exact_dedup_agrees_with_sql(spark):
    assert records(QUERIES["op9_exact_dedup"](spark, SF)) == oracle(ORACLE["op9_exact_dedup"])


def test_exact_dedup_odd_rows(spark):
    rows = [*ODD, (8, "A B C d e f"), (9, "É"), (10, "é"), (11, "x" * 300_000), (12, "X" * 300_000)]
    docs = docs_of(spark, rows)
    for seen in (F.lit(False), F.lit(True), F.col("doc_id") % 2 == 0, F.lit(None).cast("boolean")):
        found = exact_dedup(docs, seen).collect()
        assert len(found) == len(rows)
        by = {}
        for r in found:
            by.setdefault(r["digest"], []).append(r)
        assert sorted(len(v) for v in by.values()) == [1, 1, 1, 1, 1, 2, 2, 3]
        for group in by.values():
            assert sum(r["kept"] for r in group) == 1
            best = max((r["id"] for r in group if r["id"] is not None), default=None)
            assert all(r["keep_id"] == best and r["group_size"] == len(group) for r in group)
            assert all(r["id"] == best for r in group if r["kept"])
    assert exact_dedup(docs.limit(0), F.lit(True)).count() == 0


def test_line_dedup_agrees_with_sql(spark):
    assert records(QUERIES["op10_line_dedup"](spark, SF)) == oracle(ORACLE["op10_line_dedup"])


def test_line_dedup_odd_rows(spark):
    line = "This very line is long enough to be counted, é."
    rows = [(i, f"own {i}\n  {line.upper() if i % 2 else line}\t\n{line}") for i in range(20, 26)]
    rows += [(None, line), (30, "short\nshort"), (31, line + " " + line)] + ODD
    rows = [(i, t.replace("É", "é") if t else t) for i, t in rows]
    docs = docs_of(spark, rows)
    found = drop_repeated_lines(docs)
    assert found.columns == docs.columns + ["__lines", "__dropped"]
    got = {(r["doc_id"], r["__lines"], r["__dropped"], r["text"]) for r in found.collect()}
    assert found.count() == len(rows)
    assert (20, 3, 2, "own 20") in got and (24, 3, 2, "own 24") in got
    assert (25, 3, 0, rows[5][1]) in got and (None, 1, 0, line) in got
    assert (1, 1, 0, None) in got and (2, 1, 0, "") in got and (30, 2, 0, "short\nshort") in got
    assert drop_repeated_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("fanout", [2, 3])
def test_line_runs_hold_each_key_once(spark, fanout):
    runs, expected = LineRuns(spark, fanout), {}
    for batch in range(5):
        lines = [(bytes([k]), 100 * batch + i) for i in range(6) for k in range(batch, batch + 3)]
        runs.add(spark.createDataFrame(lines, "key binary, id long"))
        for k, i in lines:
            expected.setdefault(k, set()).add(i)
        # The anti-join decides: a key a run holds enters no other.
        held = [bytes(r["key"]) for run in runs.runs() for r in run.collect()]
        assert sorted(held) == sorted(expected)
    assert sum(map(len, runs.levels)) < 5
    got = {bytes(r["key"]): (r["docs"], r["last_id"]) for r in runs.frequent(1).collect()}
    assert got == {k: (len(v), max(v)) for k, v in expected.items()}
    assert runs.frequent(7).count() == sum(len(v) >= 7 for v in expected.values())


def test_line_runs_are_read_bucket_by_bucket(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = LineRuns(spark)
        for batch in range(2):
            runs.add(spark.createDataFrame([(bytes([k, batch * (k % 2)]), k) for k in range(50)], "key binary, id long"))
        first, second = runs.runs()
        joined = second.join(first.select("key"), "key", "left_anti")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and joined.count() == 25 == second.count()
        assert runs.added().count() == 25
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_line_dedup_with_clashing_columns(spark):
    line = "a line of more than forty characters, in every document"
    rows = [(i, f"own {i}\n{line}", 1, "k", 2, 3) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id long, __keys string, __lines long, __dropped long")
    found = drop_repeated_lines(docs)
    assert found.columns == ["doc_id", "text", "__id", "__keys", "__lines", "__dropped"]
    assert sorted(map(tuple, found.collect())) == [(i, f"own {i}", 1, "k", 2, 1) for i in range(5)] + [(5, rows[5][1], 1, "k", 2, 0)]


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    edges = [(a := rng.randrange(120), a + rng.randrange(1, 4)) for _ in range(60)] + [(300 + i, 301 + i) for i in range(12)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
