"""Registered queries: agreement with their SQL, and the plans they run."""

import contextlib
import io
import re

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from check import TABLES, rows_of
from finlake.operators import enrich, metrics, reports
from finlake.plans import ORACLE, QUERIES
from finlake.session import configure, size_in_bytes
from finlake.sources.testdata import eventos, transacoes


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())


def test_every_library_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ["rolling_30d", "rolling_skewed", "fraud_features", "other_transactions_open"])
def test_ordered_operators_read_the_fact_twice_at_most(spark, name):
    df = QUERIES[name](spark, SF)
    df.collect()
    final = plan(df).partition("== Initial Plan ==")[0]
    assert 1 <= final.count("- Scan parquet") <= 2


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_everything_or_leaves_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "PythonUDF"):
        assert bad not in text


@pytest.mark.parametrize("name", ["risk_score", "score_behaviour", "score_activity", "score_concentration"])
def test_distinct_counts_stay_in_hash_aggregates(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "HashAggregate" in text and "ObjectHashAggregate" not in text and "SortAggregate" not in text and "Expand" not in text


def test_time_filters_reach_the_scan(spark):
    recent = plan(enrich.last_n_days(transacoes(spark, SF), 90, "2001-11-05").select("valor"))
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(l_shipdate,2001-08-07", recent)
    assert "ReadSchema: struct<l_extendedprice:double,l_shipdate:timestamp>" in recent
    month = plan(reports.monthly_statistics(eventos(spark, SF), 2024, 1))
    assert "GreaterThanOrEqual(ts,2024-01-01" in month and "LessThan(ts,2024-02-01" in month
    window = plan(metrics.aggregate_windows(transacoes(spark, SF), (1, 7, 30), "2001-11-05"))
    assert "GreaterThanOrEqual(l_shipdate,2001-10-06" in window


def test_risk_score_reads_each_table_for_its_columns_only(spark):
    text = plan(entry.queries()["risk_score"](spark, SF))
    assert "l_discount" not in text and "l_tax" not in text and "o_orderdate" not in text


@pytest.mark.parametrize("name", ["account_behaviour", "customer_profile"])
def test_wide_sums_are_not_repeated_for_each_counted_column(spark, name):
    assert "Expand" not in plan(QUERIES[name](spark, SF))


def test_parts_are_bounded_and_smaller_ones_kept(spark):
    split, joined = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = [spark.conf.get(split), spark.conf.get(joined)]
    try:
        spark.conf.set(split, "128MB")
        spark.conf.set(joined, "8m")
        configure(spark)
        assert [spark.conf.get(split), spark.conf.get(joined)] == [str(16 << 20), "8m"]
    finally:
        spark.conf.set(split, before[0])
        spark.conf.set(joined, before[1])
    assert [size_in_bytes(s) for s in ("1024", "64m", "128MB", "7b", "2 KiB")] == [1024, 64 << 20, 128 << 20, 7, 2048]
