"""Exact duplicates through a minimal perfect hash over the digests seen before.

History is summarised per digest, dealt to shards by digest and stored as one row per shard: the hash, and per slot the
full digest, the locator of the winning row and the number of rows. A new batch is summarised per digest first, so a
text that fills a third of the batch is one lookup; digests found in their slot update it, all others form groups of
their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import minimal_hash
from .common import as_bytes, per_batch, settle

SLOTS_PER_SHARD = 1 << 10
_GROUP = "digest binary, best_id long, best_row long, size long"
_INDEX = "shard long, level_sizes array<long>, bits binary, digests binary, best_ids array<long>, best_rows array<long>, sizes array<long>"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *keep) -> DataFrame:
    """One row per document: its locator (id and row number), the SHA-256 of its text with A-Z lower-cased.

    A null text counts as empty. ``keep`` are further columns to carry.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *keep
    )
    extra = [f for f in rows.schema.fields if f.name not in ("row", "id", "text")]

    def build():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [hashlib.sha256(x.lower()).digest() for x in as_bytes(batch.column("text"))]
            columns = [batch.column("row"), batch.column("id"), pa.array(found, pa.binary())]
            return pa.RecordBatch.from_arrays(
                columns + [batch.column(f.name) for f in extra], ["row", "id", "digest"] + [f.name for f in extra]
            )

        return run

    schema = T.StructType([*T.StructType.fromDDL("row long, id long, digest binary").fields, *extra])
    return per_batch(rows, build, schema)


def groups(rows: DataFrame) -> DataFrame:
    """Rows per digest with the locator of the largest id (the last row where ids repeat)."""
    best = F.max(F.struct("id", "row"))
    return rows.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("size")).select(
        "digest", F.col("best.id").alias("best_id"), F.col("best.row").alias("best_row"), "size"
    )


def _sharded(frame: DataFrame, shards: int) -> DataFrame:
    return frame.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard of the summarised history (see ``groups``)."""

    def build(table: pa.Table) -> pa.Table:
        held = table.column("digest").to_pylist()
        words = minimal_hash.words_of(held)
        sizes, bits = minimal_hash.build(words)
        place = minimal_hash.slots(words, sizes, bits)
        order = np.empty(len(place), np.int64)
        order[place] = np.arange(len(place))
        taken = table.take(pa.array(order))
        return pa.table({
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
            "level_sizes": pa.array([sizes], pa.list_(pa.int64())),
            "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            "digests": pa.array([words[order].tobytes()], pa.binary()),
            "best_ids": pa.array([taken.column("best_id").to_pylist()], pa.list_(pa.int64())),
            "best_rows": pa.array([taken.column("best_row").to_pylist()], pa.list_(pa.int64())),
            "sizes": pa.array([taken.column("size").to_pylist()], pa.list_(pa.int64())),
        })

    return _sharded(history, shards).groupBy("shard").applyInArrow(build, _INDEX)


def look_up(new: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Groups of history and a new summarised batch together; ``member`` tells whether history held the digest."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        held = left.column("digest").to_pylist()
        ids, rows, sizes = (left.column(c).to_pylist() for c in ("best_id", "best_row", "size"))
        member = [False] * len(held)
        if right.num_rows:
            shard = right.to_pylist()[0]
            total = sum(shard["level_sizes"])
            bits = np.unpackbits(np.frombuffer(shard["bits"], np.uint8), count=total).astype(bool)
            stored = np.frombuffer(shard["digests"], "<u8").reshape(-1, 4)
            words = minimal_hash.words_of(held)
            place = minimal_hash.slots(words, shard["level_sizes"], bits)
            equal = place >= 0
            equal[equal] = (stored[place[equal]] == words[equal]).all(axis=1)
            touched = set()
            for i in np.flatnonzero(equal).tolist():
                slot = int(place[i])
                touched.add(slot)
                member[i] = True
                sizes[i] += shard["sizes"][slot]
                old = (shard["best_ids"][slot], shard["best_rows"][slot])
                if ids[i] is None or old[0] is not None and old > (ids[i], rows[i]):
                    ids[i], rows[i] = old if old[0] is not None or old[1] > rows[i] else (ids[i], rows[i])
            for slot in range(len(stored)):
                if slot not in touched:
                    held.append(stored[slot].tobytes())
                    ids.append(shard["best_ids"][slot])
                    rows.append(shard["best_rows"][slot])
                    sizes.append(shard["sizes"][slot])
                    member.append(True)
        return pa.table({
            "digest": pa.array(held, pa.binary()), "best_id": pa.array(ids, pa.int64()),
            "best_row": pa.array(rows, pa.int64()), "size": pa.array(sizes, pa.int64()),
            "member": pa.array(member, pa.bool_()),
        })

    left, right = _sharded(new, shards).groupBy("shard"), index.groupBy("shard")
    return left.cogroup(right).applyInArrow(run, _GROUP + ", member boolean")


def exact_dedup(docs: DataFrame, seen, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with the row that stays for its text.

    ``seen`` is a flag column over ``docs``: true for rows that came before the present batch. Texts are equal when
    identical after lower-casing A-Z; null counts as empty. The largest id stays, rows without an id only where no row
    has one; of rows that repeat the id too, the last read stays. An empty table gives an empty result.
    Returns id, digest, keep_id, group_size, kept, member (the text was in history).
    """
    rows = settle(digests(docs, id_col, text_col, F.coalesce(seen, F.lit(False)).alias("old")), "digests")
    old, new = groups(rows.where("old")), groups(rows.where("NOT old"))
    distinct = rows.select(F.approx_count_distinct("digest", 0.02)).first()[0]
    shards = max(1, -(-distinct // SLOTS_PER_SHARD))
    index = settle(build_index(old, shards), "digest-index")
    found = look_up(new, index, shards)
    return rows.join(found, "digest").select(
        "id", "digest", F.col("best_id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("best_row")).alias("kept"), "member",
    )
