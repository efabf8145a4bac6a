"""Exact distinct counts as bitmaps against sets."""

import contextlib
import io
import random
from collections import defaultdict
from datetime import date, timedelta

from conftest import rows
from pyspark.sql import functions as F

from finlake.functions.bitmaps import distinct_counts


def test_counts_against_sets(spark):
    rng = random.Random(4)
    data = [
        (rng.choice([1, 2, 3, None]), rng.choice([None, date(1969, 6, 1) + timedelta(days=rng.randint(0, 900))]),
         rng.choice([None, *(f"c{i}" for i in range(300))]), rng.choice([None, 1.5, -0.25, 7.0]), rng.random() < 0.3)
        for _ in range(3000)
    ] + [(9, None, None, None, None)]
    df = spark.createDataFrame(data, "k long, d date, city string, number double, flag boolean").repartition(7)
    got = distinct_counts(df, "k", {"days": F.col("d")}, {"cities": "city", "numbers": "number"}, {"all": F.lit(True), "flags": F.col("flag")})
    sets, counts = defaultdict(lambda: [set(), set(), set()]), defaultdict(lambda: [0, 0])
    for k, *values, flag in data:
        for seen, v in zip(sets[k], values, strict=True):
            if v is not None:
                seen.add(v)
        counts[k][0] += 1
        counts[k][1] += bool(flag)
    assert got.columns == ["k", "all", "flags", "days", "cities", "numbers"]
    assert rows(got) == sorted(((k, *counts[k], *map(len, sets[k])) for k in sets), key=repr)


def test_one_key_with_most_rows_and_no_rows(spark):
    df = spark.range(200_000).select(F.lit(1).alias("k"), F.date_add(F.lit("2000-01-01"), (F.col("id") % 5000).cast("int")).alias("d"))
    assert rows(distinct_counts(df, "k", {"n": F.col("d")})) == [(1, 5000)]
    assert distinct_counts(df.where("k = 2"), "k", {"n": F.col("d")}, {"m": "d"}).count() == 0


def test_rows_are_not_dealt_out_by_a_counted_value(spark):
    """A join on the value would put all rows of a value into one task."""
    df = spark.range(1000).select((F.col("id") % 100).alias("k"), F.lit("PIX").alias("kind"), F.date_add(F.lit("2000-01-01"), (F.col("id") % 7).cast("int")).alias("d"))
    got = distinct_counts(df, "k", {"days": F.col("d")}, {"kinds": "kind"})
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        got.explain("simple")
    assert "Join" not in out.getvalue() and out.getvalue().count("Range") == 1
    assert rows(got.where("k < 2")) == [(0, 7, 1), (1, 7, 1)]
