"""Exact distinct counts, of days as bitmaps of 64-bit words.

A day's number n is bit ``n % 64`` of word ``n // 64``. Words of the same key and number merge with ``bit_or``, whose
buffer has a fixed width, so they stay in Spark's hash aggregate and combine on the map side; a set per key would not.
Other values are grouped as they are: looking numbers up for them would deal the rows out by value, and a few values
put all rows into a few tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_of(number: Column) -> Column:
    return F.shiftright(number, 6)


def bit_of(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(64)).cast("int"))


def distinct_counts(
    df: DataFrame, key: str, days: Mapping[str, Column] | None = None, values: Mapping[str, str] | None = None,
    counts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key: how often each condition in ``counts`` holds, and exact numbers of distinct values.

    ``days`` names date expressions, whose day number is the bit; ``values`` names columns, whose values are told
    apart as text. NULL is no value; a key that has none counts 0. The largest intermediate result has one row per key,
    counted thing and word or value. The rows are read once and dealt out by key, thing and word or value together.
    """
    days, values, counts = days or {}, values or {}, counts or {}
    coded = df.select(
        F.col(key).alias("_key"), *[c.cast("boolean").alias(f"_c_{n}") for n, c in counts.items()],
        *[F.unix_date(c).cast("long").alias(f"_n_{n}") for n, c in days.items()],
        *[F.col(c).cast("string").alias(f"_v_{n}") for n, c in values.items()],
    )
    things = [*days, *values]

    def entry(i: int, name: str) -> Column:
        if name in days:
            number, value = F.col(f"_n_{name}"), F.lit(None).cast("string")
            word, bits = word_of(number), bit_of(number)
        else:
            word, value = F.lit(None).cast("long"), F.col(f"_v_{name}")
            bits = F.when(value.isNotNull(), F.lit(1).cast("long"))
        # Conditions are counted with the first thing only: each row gives one entry for each thing.
        held = [(F.col(f"_c_{n}").cast("long") if i == 0 else F.lit(0).cast("long")).alias(f"_c_{n}") for n in counts]
        return F.struct(F.lit(i).alias("_i"), word.alias("_word"), value.alias("_value"), bits.alias("_bits"), *held)

    entries = coded.select("_key", F.inline(F.array(*[entry(i, n) for i, n in enumerate(things)])))
    words = entries.groupBy("_key", "_i", "_word", "_value").agg(
        F.bit_or("_bits").alias("_bits"), *[F.sum(f"_c_{n}").alias(f"_c_{n}") for n in counts]
    )
    size = F.coalesce(F.bit_count("_bits"), F.lit(0)).cast("long")
    return words.groupBy(F.col("_key").alias(key)).agg(
        *[F.coalesce(F.sum(f"_c_{n}"), F.lit(0)).alias(n) for n in counts],
        *[F.sum(F.when(F.col("_i") == i, size).otherwise(0)).alias(n) for i, n in enumerate(things)],
    )

