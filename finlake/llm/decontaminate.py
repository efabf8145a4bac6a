"""Benchmark decontamination by winnowing.

Every ``WINDOW - GRAM + 1`` consecutive grams of a text contribute the smallest of their hashes as a fingerprint, so two
texts that share ``WINDOW`` words share the fingerprint chosen there. Fingerprints of documents and items are joined;
each meeting is extended word by word and counts if the shared run is a whole window. Items shorter than a window are
one gram of their own length, looked for at every position. Before the join, document fingerprints pass a bit map of
the items' ones, of fixed size: it only spares shuffling, a full map would let everything through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, fields_and, per_batch, settle
from .words import WordHashes, alnum_words, chunks, grams

WINDOW, GRAM = 10, 5
MAP_BITS = 1 << 23
_BUCKET_BITS = 1 << 15  # fixed value: bits in one bucket of bitmap_construct_agg
_PRINTS = "array<struct<print: long, size: int, at: int, words: array<long>>>"
_PRINT_TYPE = pa.list_(pa.struct([
    ("print", pa.int64()), ("size", pa.int32()), ("at", pa.int32()), ("words", pa.list_(pa.int64()))
]))


def winnowed(values: np.ndarray, ends: np.ndarray, span: int) -> np.ndarray:
    """Places of the smallest value in each ``span`` consecutive ones of the same text, leftmost among equals.

    ``ends`` is, for each place, where the grams of its text end.
    """
    n = len(values) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = values[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, span):
        less = values[j : j + n] < best
        best[less] = values[j : j + n][less]
        at[less] = j
    starts = np.arange(n)
    return np.unique((starts + at)[starts + span <= ends[:n]])


def _around(words: np.ndarray, at: np.ndarray, first: np.ndarray, end: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each gram the words of all windows around it: which of these places lie in the text, and their words."""
    places = at[:, None] + np.arange(gram - window, window)[None, :]
    inside = (places >= first[:, None]) & (places < end[:, None])
    return inside, words[np.clip(places, 0, len(words) - 1)].view(np.int64)


def _prints(counts: np.ndarray, words: np.ndarray, window: int, gram: int, lengths: list[int], whole_short: bool, keep):
    """Per text its fingerprints (print, size, place in the text, words around)."""
    ends = np.cumsum(counts)
    starts = ends - counts
    text_of = np.repeat(np.arange(len(counts)), counts)
    found: list[list[dict]] = [[] for _ in counts]
    values = grams(words, gram)
    if len(values):
        gram_ends = ends[text_of[: len(values)]] - gram + 1
        at = winnowed(values, gram_ends, window - gram + 1)
        at = at[keep(values[at])]
        inside, around = _around(words, at, starts[text_of[at]], ends[text_of[at]], window, gram)
        for i, p in enumerate(at.tolist()):
            near = [w if ok else None for w, ok in zip(around[i].tolist(), inside[i].tolist(), strict=True)]
            t = int(text_of[p])
            found[t].append({"print": int(values[p].view(np.int64)), "size": window, "at": p - int(starts[t]), "words": near})
    for m in lengths:
        values = grams(words, m)
        if not len(values):
            continue
        fits = ends[text_of[: len(values)]] - np.arange(len(values)) >= m
        if whole_short:
            fits &= counts[text_of[: len(values)]] == m
        at = np.flatnonzero(fits)
        at = at[keep(values[at])]
        for p in at.tolist():
            t = int(text_of[p])
            found[t].append({"print": int(values[p].view(np.int64)), "size": m, "at": p - int(starts[t]),
                             "words": words[p : p + m].view(np.int64).tolist()})
    return found


def fingerprints(texts: DataFrame, window: int, gram: int, lengths: list[int], items: bool, bit_map: bytes | None = None) -> DataFrame:
    """The rows without their text, with n_words and prints; short grams of ``lengths`` words (items: whole texts)."""
    kept = [f for f in texts.schema.fields if f.name != "text"]

    def build():
        hashes = WordHashes()
        bits = None if bit_map is None else np.unpackbits(np.frombuffer(bit_map, np.uint8), bitorder="little").astype(bool)

        def keep(values: np.ndarray) -> np.ndarray:
            return np.ones(len(values), bool) if bits is None else bits[(values % np.uint64(len(bits))).astype(np.int64)]

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_words, prints = [], []
            for _, counts, words in chunks(as_bytes(batch.column("text")), alnum_words, hashes):
                n_words += counts.tolist()
                prints += _prints(counts, words, window, gram, lengths, items, keep)
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array(n_words, pa.int64()), pa.array(prints, _PRINT_TYPE)]
            return pa.RecordBatch.from_arrays(columns, [f.name for f in kept] + ["n_words", "prints"])

        return run

    return per_batch(texts, build, fields_and(kept, f"n_words long, prints {_PRINTS}"))


def _bit_map(prints: DataFrame) -> bytes:
    """MAP_BITS bits, set at each item fingerprint modulo their number."""
    place = F.col("print").bitwiseAND(F.lit(MAP_BITS - 1)) + 1  # MAP_BITS is a power of two
    rows = prints.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    ).collect()  # MAP_BITS / _BUCKET_BITS rows at most
    out = bytearray(MAP_BITS // 8)
    for row in rows:
        first = (row["bucket"] - 1) * (_BUCKET_BITS // 8)
        out[first : first + len(row["bits"])] = row["bits"]
    return bytes(out)


def _extended(met: DataFrame, window: int, gram: int) -> DataFrame:
    """Meetings whose shared run is a whole window (or short item): row, item_id, first, end of the run."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        first, end, good = [], [], []
        left = window - gram
        for mine, its, size, at in zip(*(batch.column(c).to_pylist() for c in ("words", "item_words", "size", "at")), strict=True):
            if size < window:
                good.append(mine == its)
                first.append(at)
                end.append(at + size)
                continue
            same = [a is not None and a == b for a, b in zip(mine, its, strict=True)]
            lo, hi = left, left + gram
            ok = all(same[lo:hi])
            while ok and lo > 0 and same[lo - 1]:
                lo -= 1
            while ok and hi < len(same) and same[hi]:
                hi += 1
            good.append(ok and hi - lo >= window)
            first.append(at + lo - left)
            end.append(at + hi - left)
        out = pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("item_id"), pa.array(first, pa.int32()), pa.array(end, pa.int32())],
            ["row", "item_id", "first", "end"],
        )
        return out.filter(pa.array(good, pa.bool_()))

    return per_batch(met, lambda: run, "row long, item_id string, first int, end int")


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, gram: int = GRAM, row_col: str | None = None,
) -> DataFrame:
    """Every document row with the words that occurrences of item windows cover.

    Returns row (``row_col`` of a stored table, else numbers known in the result only), id, n_words, n_hit, item_ids (sorted as text, each once), spans (first and end word of the shared runs). A
    null or empty text has no words, an item without words has no window, an item without an id goes as ''. Repeated rows
    are looked at one by one; empty tables give empty results or no hits.
    """
    item_rows = items.select(F.coalesce(F.col(item_id_col).cast("string"), F.lit("")).alias("item_id"), F.col(item_text_col).alias("text"))
    of_items = settle(
        fingerprints(item_rows, window, gram, list(range(1, window)), True).select("item_id", F.explode("prints").alias("p"))
        .select("item_id", "p.print", "p.size", F.col("p.words").alias("item_words")).distinct(), "item-prints",
    )
    lengths = [r[0] for r in of_items.where(F.col("size") < window).select("size").distinct().collect()]
    doc_rows = docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    of_docs = settle(fingerprints(doc_rows, window, gram, lengths, False, _bit_map(of_items)), "doc-prints")
    met = of_docs.select("row", F.explode("prints").alias("p")).select("row", "p.*").join(of_items, ["print", "size"])
    runs = _extended(met, window, gram).groupBy("row").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.array_sort(F.collect_set(F.struct("first", "end"))).alias("spans"),
    )
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda a, s: F.struct(
            (a.n + F.greatest(F.lit(0), s.end - F.greatest(s["first"], a.upto))).alias("n"), F.greatest(a.upto, s.end).alias("upto")
        ),
    ).n
    runs = runs.withColumn("n_hit", covered)
    return of_docs.select("row", "id", "n_words").join(runs, "row", "left").select(
        "row", "id", "n_words", F.coalesce(F.col("n_hit"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), "spans",
    )
