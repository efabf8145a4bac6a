"""Importance resampling towards a target distribution of hashed word n-grams.

Words are cut with one translate table and ``bytes.split``; the hash of a longer n-gram continues the hash of its first
words, as CRC-32 takes the value so far as its seed. Counters of all tasks add up to how often each bucket occurs in the
corpus and in the target. A document's weight is the sum of the gains of its features; with Gumbel noise from its id added,
the highest scores are a sample without replacement that follows the weights.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, fields_and, per_batch, settle

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024
#: Words and features that a task remembers at most before it begins anew.
MAX_HELD = 1 << 19

# Lower-cases A-Z; ASCII characters but letters and digits become blanks, bytes of other characters stay.
_TABLE = bytes(range(256)).lower()
_TABLE = bytes(b if b >= 128 or bytes([b]).isalnum() else 32 for b in _TABLE)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class _Seeds(dict):
    """CRC-32 of each word met."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_HELD:
            self.clear()
        value = self[word] = crc32(word)
        return value


def levels(words: list[bytes], max_gram: int, seeds: dict[bytes, int]) -> Iterator[list[int]]:
    """CRC-32 of all runs of 1, 2 ... ``max_gram`` words joined by a blank."""
    found = list(map(seeds.__getitem__, words))
    yield found
    if max_gram > 1:
        spaced = [b" " + w for w in words]
        for n in range(1, max_gram):
            found = list(map(crc32, spaced[n:], found))
            yield found


def bucket_counts(docs: DataFrame, text_col: str = "text", max_gram: int = 1, buckets: int = BUCKETS) -> list[int]:
    """How often each bucket occurs in all texts; the sums of the tasks' counters, one number per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, held, total = _Seeds(), Counter(), Counter()

        def fold() -> None:
            for seed, n in held.items():
                total[seed % buckets] += n
            held.clear()

        for batch in batches:
            for text in as_bytes(batch.column(0)):
                for found in levels(words_of(text), max_gram, seeds):
                    held.update(found)
                if len(held) >= MAX_HELD:
                    fold()
        fold()
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int32()), pa.array(total.values(), pa.int64())], ["bucket", "n"])

    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * buckets
    for row in counts.collect():  # a row per bucket at most
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(raw: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of a bucket's smoothed share in the target and in the corpus, rounded down."""
    size, of_raw, of_target = float(len(raw)), float(sum(raw)), float(sum(target))
    return [
        math.floor(1000 * math.log((t + 1.0) * (of_raw + size) / ((s + 1.0) * (of_target + size))))
        for s, t in zip(raw, target, strict=True)
    ]


def noise(row_id: object, seed: int) -> int:
    """Gumbel noise in thousandths from the id; a null id counts as empty text."""
    h = int(sha256(f"{seed}:{'' if row_id is None else row_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gains: list[int], id_col: str, text_col: str, max_gram: int, seed: int) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["id", "n_words", "n_features", "weight", "score"]

    def build():
        seeds, buckets = _Seeds(), len(gains)

        class Gains(dict):
            def __missing__(self, found: int) -> int:
                if len(self) >= MAX_HELD:
                    self.clear()
                value = self[found] = gains[found % buckets]
                return value

        gain = Gains()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_words, n_features, weights, scores = [], [], [], []
            for row_id, text in zip(batch.column("id").to_pylist(), as_bytes(batch.column("text")), strict=True):
                words, size, weight = words_of(text), 0, 0
                for found in levels(words, max_gram, seeds):
                    size += len(found)
                    weight += sum(map(gain.__getitem__, found))
                n_words.append(len(words))
                n_features.append(size)
                weights.append(weight)
                scores.append(weight + noise(row_id, seed))
            return pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weights, scores))], names
            )

        return run

    return per_batch(rows, build, fields_and(rows.schema.fields[:1], "n_words long, n_features long, weight long, score long"))


def importance_resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    max_gram: int = 1, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; rank counts from 1 through the rows drawn, others have null.

    Of the rows with at least ``min_words`` words, ``percent`` of a hundred with the highest score are drawn, ties to the
    smaller id. A null or empty text has no features and weight 0; texts may be of any length. Rows without an id are
    scored as if the id were empty and come after others of the same score; rows that repeat an id are ranked each, in any
    order where score and id are the same. An empty table gives no rows, an empty target counts as zeros.

    All rows are sorted by ranges of score and id and written; a row's place is its number within its range plus the sizes
    of the ranges before, so no task sees more than its range.
    """
    gains = bucket_gains(
        bucket_counts(docs, text_col, max_gram, buckets), bucket_counts(target, target_text_col, max_gram, buckets)
    )
    scored = weighted(docs, gains, id_col, text_col, max_gram, seed)
    # The number only splits rows that are equal otherwise.
    scored = settle(scored.withColumn("number", F.monotonically_increasing_id()), "weighted")
    fit = F.col("n_words") >= min_words
    drawn = scored.where(fit).count() * percent // 100
    ordered = scored.withColumn("fit", fit).orderBy(F.desc("fit"), F.desc("score"), F.asc_nulls_last("id"), "number")
    ordered = settle(ordered.withColumn("place", F.monotonically_increasing_id()), "ordered")
    # monotonically_increasing_id: the partition above 33 bits, the row in the partition below.
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r["part"], r["n"]) for r in ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = 0, []
    for name, n in sizes:
        starts.append((name, before))
        before += n
    start = docs.sparkSession.createDataFrame(starts, "part long, start long")
    rank = F.col("start") + within + 1
    return ordered.withColumn("part", part).join(start, "part").select(
        "id", "n_features", "weight", "score", F.when(F.col("fit") & (rank <= drawn), rank).alias("rank")
    )
