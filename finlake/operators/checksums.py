"""Which rows of two copies of a table differ, by checksums of key ranges.

Keys are dealt to ranges by their hash. Each side gives every range a count and two sums of row hashes, which do not
depend on the order of the rows; only ranges whose sums differ are cut into finer ones and, at last, only rows of finest
ranges that differ are moved and compared. Two different sets of rows with equal counts and sums would go unseen: the sums
are of 64-bit hashes with different seeds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .audit import changed_fields

#: Bits of the ranges of each level: about a thousand, and a thousand in each of those.
LEVELS = (10, 20)


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys])


def _range(keys: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(_key_hash(keys), 64 - bits)


def range_sums(df: DataFrame, keys: Sequence[str], names: Sequence[str], bits: int) -> DataFrame:
    """(faixa, n, soma, soma2) of each key range; columns the table lacks count as NULL, values as text."""
    values = [F.col(f"`{c}`").cast("string") if c in df.columns else F.lit(None).cast("string") for c in names]
    # xxhash64 passes over NULL: their places are hashed with the values.
    places = F.concat_ws("", *[v.isNull().cast("int").cast("string") for v in values])
    row = F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys], places, *values)
    again = F.xxhash64(F.lit("2"), row, *values)
    return df.groupBy(_range(keys, bits).alias("faixa")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("soma"), F.sum(again.cast("decimal(38,0)")).alias("soma2")
    )


def differing_ranges(old: DataFrame, new: DataFrame, keys: Sequence[str], bits: int, names: Sequence[str] | None = None) -> DataFrame:
    """(faixa) of the key ranges whose rows are not the same on both sides."""
    names = names if names is not None else list(dict.fromkeys(c for c in [*old.columns, *new.columns] if c not in keys))
    sums = [range_sums(df, keys, names, bits).select("faixa", F.struct("n", "soma", "soma2").alias(s)) for df, s in ((old, "o"), (new, "n"))]
    return sums[0].join(sums[1], "faixa", "full_outer").where(~F.col("o").eqNullSafe(F.col("n"))).select("faixa")


def differing_rows(
    old: DataFrame, new: DataFrame, keys: Sequence[str], levels: Sequence[int] = LEVELS
) -> tuple[DataFrame, DataFrame]:
    """Both sides without the rows of key ranges that are the same; rows with a NULL key stay, as they meet nobody."""
    names = list(dict.fromkeys(c for c in [*old.columns, *new.columns] if c not in keys))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(f"`{k}`").isNull()
    keyless = [df.where(no_key) for df in (old, new)]
    sides = [df.where(~no_key) for df in (old, new)]
    for bits in levels:
        ranges = differing_ranges(*sides, keys, bits, names)
        sides = [
            df.withColumn("_faixa", _range(keys, bits)).join(ranges.withColumnRenamed("faixa", "_faixa"), "_faixa", "left_semi").drop("_faixa")
            for df in sides
        ]
    return tuple(side.unionByName(rows) for side, rows in zip(sides, keyless, strict=True))


def changed_by_ranges(old: DataFrame, new: DataFrame, keys: Sequence[str], levels: Sequence[int] = LEVELS) -> DataFrame:
    """``audit.changed_fields`` of tables whose keys are unique, moving only rows near the differences."""
    return changed_fields(*differing_rows(old, new, keys, levels), keys)
