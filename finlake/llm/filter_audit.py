"""Audit of text filters: what each filter removes in every order in which all of them may be applied.

Each document gets the set of filters it fails as a mask; documents of a part (a language) with the same mask form one
cell with its counts, so what follows does not grow with the documents. A recursive query then extends each prefix of
filters by every letter not yet used: it joins the cells of the part, carries the bits applied so far and gives the
counts of that step. Every full order is finally read off as its five prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_bytes, fields_and, per_batch, settle

LETTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 3
REPEATED = 1 << LETTERS.index("E")

_UPPER = bytes(range(65, 91))
_CONTINUED = bytes(range(128, 192))  # bytes of a character after its first
_SYMBOLS = b"#$%&*|"

_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _CONTINUED))
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
        100 * upper > MAX_UPPER_PERCENT * points,
        len(text.translate(None, _SYMBOLS)) < len(text),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def text_masks(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(id, part, mask, digest) of every row; digest is the SHA-256 of the text, a null text is empty."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).alias("text"),
    )

    def build():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = as_bytes(batch.column("text"))
            masks = pa.array(map(text_mask, texts), pa.int32())
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("part"), masks, digests], ["id", "part", "mask", "digest"])

        return run

    return per_batch(rows, build, fields_and(rows.schema.fields[:2], "mask int, digest binary"))


def filter_cells(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
    good_col: str = "quality", toxic_col: str = "toxic",
) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and by the filters they fail.

    A text fails E where a smaller id has the same text anywhere in the table. Rows are counted by id and digest first
    and copies by digest, part and mask then, so a text that many documents share is a few rows when its smallest id is
    looked up. Rows without an id are never repeats and make no others so; they carry no label. Of repeated label rows
    any 1 counts. Rows that repeat an id are counted each.
    """
    flags = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.coalesce(F.col(good_col) == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col(toxic_col) == 1, F.lit(False))).alias("toxic"),
    )
    marked = text_masks(docs, id_col, text_col, part_col).join(flags, "id", "left")
    flag = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")]
    ids = marked.groupBy("id", "digest", "part", "mask", *flag).agg(F.count(F.lit(1)).alias("n"))
    copies = ids.groupBy("digest", "part", "mask", "good", "toxic", F.col("id").isNotNull().alias("named")).agg(
        F.sum("n").alias("n"), F.min("id").alias("first"), F.min_by("n", "id").alias("n_first")
    )
    # A digest has a row for each part and label here, however many documents share it.
    least = F.min("first").over(Window.partitionBy("digest"))
    later = F.when(~F.col("named"), 0).when(F.col("first") == F.col("least"), F.col("n") - F.col("n_first")).otherwise(F.col("n"))
    split = copies.withColumn("least", least).withColumn("later", later).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct("mask", (F.col("n") - F.col("later")).alias("n")),
            F.struct(F.col("mask").bitwiseOR(REPEATED).alias("mask"), F.col("later").alias("n")),
        )).alias("cell"),
    )
    counts = split.select("part", "cell.mask", "cell.n", "good", "toxic").where("n > 0")
    return counts.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def _total(count: str, condition: str) -> str:
    return f"aggregate(p.cells, 0L, (a, c) -> a + if({condition}, c.{count}, 0L))"


_FAILS, _LEFT = "c.mask & l.bit <> 0", "c.mask & s.applied = 0"
_STEPS = f"""
    WITH RECURSIVE steps(part, prefix, applied, step, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
        SELECT part, '', 0, 0, '', 0L, 0L, 0L, 0L, 0L, 0L FROM {{parts}}
        UNION ALL
        SELECT s.part, concat(s.prefix, l.letter), s.applied | l.bit, s.step + 1, l.letter,
               {_total("n", "c.mask & (s.applied | l.bit) = 0")},
               {_total("n", f"{_FAILS} AND {_LEFT}")},
               {_total("n", f"{_FAILS} AND NOT {_LEFT}")},
               {_total("n", "c.mask = l.bit")},
               {_total("good", f"{_FAILS} AND {_LEFT}")},
               {_total("toxic", f"{_FAILS} AND {_LEFT}")}
        FROM steps s JOIN {{parts}} p ON s.part = p.part
        LATERAL VIEW explode(filter(transform(sequence(1, :n), i -> named_struct('letter', substr(:letters, i, 1), 'bit', shiftleft(1, i - 1))),
                                    x -> s.applied & x.bit = 0)) AS l
        WHERE s.step < :n)
    SELECT * FROM steps WHERE step > 0"""


@contextmanager
def _whole_recursion(spark: SparkSession) -> Iterator[None]:
    """The recursion has a bounded number of rows for each part; the number of parts is not bounded."""
    before = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.set(_ROW_LIMIT, before)


def filter_steps(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, prefix, letter, step, counts) for every part of the cells and every sequence of different letters.

    ``cells`` has part, mask and the counts n, good and toxic; bit i of the mask stands for letter i. A part has at most
    one cell for each of the masks, so its cells fit in one row.
    """
    spark = cells.sparkSession
    parts = settle(cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")), "filter-cells")
    with _whole_recursion(spark):
        steps = spark.sql(_STEPS, {"n": len(letters), "letters": letters}, parts=parts)
        return settle(steps.drop("applied"), "filter-steps")


def filter_orders(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of all letters and step, with the counts of that step and the letter's Shapley sum.

    No cells give no rows.
    """
    steps = filter_steps(cells, letters)
    size = len(letters)
    # A prefix of s letters begins (size - s)! full orders.
    shared = F.col("removed") * F.factorial(F.lit(size) - F.col("step"))
    shapley = steps.groupBy("part", "letter").agg(F.sum(shared).alias("shapley"))
    full = steps.where(F.col("step") == size).select(
        "part", F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(size))).alias("step")
    ).withColumn("prefix", F.col("filter_order").substr(F.lit(1), F.col("step")))
    return (
        full.join(steps.drop("step"), ["part", "prefix"]).join(shapley, ["part", "letter"])
        .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    )


def filter_audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The audit of the filters A to E over whole texts; see ``filter_cells`` and ``filter_orders``.

    A null or empty text has no words: it fails A only, and E where a smaller id has such a text too. Texts may be of any
    length. An empty table gives no rows. Columns other than those named are not read.
    """
    return filter_orders(filter_cells(docs, labels, **columns))
