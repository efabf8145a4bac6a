"""Length buckets with the least padding, and token-budget batches inside each.

Documents longer than the context are cut into segments. A histogram over all segment lengths, of at most as many rows
as the context has tokens, goes to the driver; dynamic programming finds the bucket boundaries with the least padding.
Segments of a bucket are numbered without gathering them: each hash slot numbers its own rows, and slots add up.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .token_counts import with_token_counts

CONTEXT, BUCKETS, BUDGET, SLOT_ROWS = 2048, 8, 1 << 16, 2000


def boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """At most ``buckets`` boundaries, each a length that occurs, so that rounding up to the next pads least."""
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[int(n)] for n in lengths], np.int64)
    rows = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    size = len(lengths)
    # pad[i, j]: padding when lengths i to j - 1 go to a bucket of the length j - 1.
    upto = np.concatenate([[0], lengths])
    pad = upto[None, :] * (rows[None, :] - rows[:, None]) - (tokens[None, :] - tokens[:, None])
    pad[np.tril_indices(size + 1)] = np.iinfo(np.int64).max // 4
    best, cuts = pad[0].copy(), []
    for _ in range(min(buckets, size) - 1):
        through = best[:, None] + pad
        before = through.argmin(axis=0)
        better = through[before, np.arange(size + 1)]
        cuts.append(np.where(better < best, before, 0))
        best = np.minimum(best, better)
    out, at = [], size
    for cut in reversed(cuts):
        if at == 0:
            break
        out.append(int(lengths[at - 1]))
        at = int(cut[at])
    if at:
        out.append(int(lengths[at - 1]))
    return sorted(set(out))


def padding(histogram: dict[int, int], cuts: list[int]) -> int:
    """Padding of a histogram under given boundaries."""
    return sum(n * (min(b for b in cuts if b >= length) - length) for length, n in histogram.items())


def segments(counts: DataFrame, context: int) -> DataFrame:
    """(row, id, segment, first_token, n_tokens): documents cut at the context; an empty one is one empty segment."""
    last = F.floor((F.greatest(F.col("n_tokens"), F.lit(1)) - 1) / context).cast("int")
    rows = counts.withColumn("segment", F.explode(F.sequence(F.lit(0), last)))
    first = (F.col("segment") * F.lit(context)).cast("long")
    return rows.select("row", "id", "segment", first.alias("first_token"), F.least(F.col("n_tokens") - first, F.lit(context)).alias("n_tokens"))


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", context: int = CONTEXT,
    buckets: int = BUCKETS, budget: int = BUDGET,
) -> DataFrame:
    """One row per segment: id, segment, first_token, n_tokens, bucket_tokens, batch, place.

    A batch holds ``budget // bucket_tokens`` segments of one bucket (one at least), the last batch of a bucket may hold
    fewer. Null and empty texts are empty segments of the shortest bucket; repeated rows and rows without an id are
    packed like any other; an empty table gives an empty result.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cut = settle(segments(with_token_counts(rows, "text", tokenizer_path), context), "segments")
    histogram = {r[0]: r[1] for r in cut.groupBy("n_tokens").count().collect()}  # context + 1 rows at most
    cuts = boundaries(histogram, buckets)
    slots = max(1, sum(histogram.values()) // SLOT_ROWS)
    bucket = F.lit(cuts[-1] if cuts else 0).cast("long")
    for low in reversed(cuts[:-1]):
        bucket = F.when(F.col("n_tokens") <= low, F.lit(low).cast("long")).otherwise(bucket)
    dealt = cut.withColumns({"bucket_tokens": bucket, "slot": F.pmod(F.xxhash64("row", "segment"), F.lit(slots))})
    sizes = dealt.groupBy("bucket_tokens", "slot").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.partitionBy("bucket_tokens").orderBy("slot")) - F.col("size")
    offsets = sizes.select("bucket_tokens", "slot", before.alias("before"))
    own = F.row_number().over(Window.partitionBy("bucket_tokens", "slot").orderBy("row", "segment")) - 1
    numbered = dealt.withColumn("own", own).join(offsets, ["bucket_tokens", "slot"])
    number = F.col("own") + F.col("before")
    per_batch = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket_tokens", F.lit(1))), F.lit(1))
    return numbered.select(
        "id", "segment", "first_token", "n_tokens", "bucket_tokens",
        F.floor(number / per_batch).cast("long").alias("batch"), (number % per_batch).cast("long").alias("place"),
    )
