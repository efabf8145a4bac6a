"""Line deduplication on levelled sorted runs of line hashes.

Documents come in batches. A batch's distinct line hashes are merge-anti-joined with the runs on disk: hashes no run holds
become the batch's own run, with their counts; for the others the batch leaves an update. So every hash has its row in one
run only, and nothing is ever summed over all runs: updates are merged into their rows when a level has ``fanout`` runs and
is compacted into one of the next level, and where the counts are read. Runs are bucketed by the hash and
sorted, so each of these joins is bucket by bucket, and only the batch and the updates move. A run takes about 40 bytes a
hash.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, fields_and, per_batch, scratch_dir, settle, unused

MIN_CHARS, MIN_DOCS, BATCHES, FANOUT = 40, 5, 4, 3


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return line.strip().lower()


def key_hash(key: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a key of at least so many code points, else None."""
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


class LineRuns:
    """Runs of (key, docs, last_id): in how many documents a line occurs, the largest id among them.

    A key is in one run, that of the batch it was met in first or one compacted from it. ``updates`` hold what later
    batches add to keys that a run has.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.updates: list[str] = []

    def _place(self, label: str) -> str:
        return f"{scratch_dir(self.spark)}/finlake-llm/line-{label}-{uuid.uuid4().hex}"

    def _written(self, parts: list[DataFrame]) -> DataFrame:
        """A run of the parts' rows: files bucketed by key and sorted. The catalogue names it only until it is resolved."""
        name, path = f"finlake_line_run_{uuid.uuid4().hex}", self._place("run")
        for rows in parts:
            writer = rows.repartition(self.buckets, "key").write.mode("append").bucketBy(self.buckets, "key").sortBy("key")
            writer.option("path", path).saveAsTable(name, format="parquet")
        written = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return written

    def _update(self, rows: DataFrame) -> None:
        self.updates.append(self._place("update"))
        rows.write.parquet(self.updates[-1])

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def added(self) -> DataFrame | None:
        """(key, more, later): all updates, one row for each key."""
        if not self.updates:
            return None
        rows = self.spark.read.schema("key binary, docs long, last_id long").parquet(*self.updates)
        return rows.groupBy("key").agg(F.sum("docs").alias("more"), F.max("last_id").alias("later"))

    @staticmethod
    def _updated(run: DataFrame, added: DataFrame | None) -> DataFrame:
        if added is None:
            return run
        return run.join(added, "key", "left").select(
            "key", (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"), F.greatest("last_id", "later").alias("last_id")
        )

    def add(self, lines: DataFrame) -> None:
        """Take a batch of (key, id), of documents no earlier batch held."""
        batch = self._written([lines.select("key", "id").distinct().groupBy("key").agg(
            F.count(F.lit(1)).alias("docs"), F.max("id").alias("last_id")
        )])
        new = batch
        if self.runs():
            for run in self.runs():
                new = new.join(run.select("key"), "key", "left_anti")
            new = self._written([new])
            self._update(batch.join(new.select("key"), "key", "left_anti"))
        self._put(new, 0)

    def _put(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(self._compacted(full), level + 1)

    def _compacted(self, runs: list[DataFrame]) -> DataFrame:
        """One run of several, their updates merged in; updates of other runs stay."""
        added = self.added()
        merged = self._written([self._updated(run, added) for run in runs])
        if added is not None:
            rest = added.join(merged.select("key"), "key", "left_anti")
            self.updates = []
            self._update(rest.select("key", F.col("more").alias("docs"), F.col("later").alias("last_id")))
        return merged

    def frequent(self, min_docs: int) -> DataFrame:
        """(key, docs, last_id) of the keys held by at least so many documents, written run by run."""
        added, path = self.added(), self._place("frequent")
        for run in self.runs():
            self._updated(run, added).where(F.col("docs") >= min_docs).write.mode("append").parquet(path)
        return self.spark.read.schema("key binary, docs long, last_id long").parquet(path)


def line_hashes(docs: DataFrame, id_col: Column, text_col: Column, min_chars: int) -> DataFrame:
    """(id, keys): distinct hashes of the long lines of each document."""

    def build():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = []
            for text in as_bytes(batch.column("text")):
                found = dict.fromkeys(key_hash(line_key(line), min_chars) for line in text.split(b"\n"))
                found.pop(None, None)
                keys.append(list(found))
            return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(keys, pa.list_(pa.binary()))], ["id", "keys"])

        return run

    return per_batch(docs.select(id_col.cast("long").alias("id"), text_col.alias("text")), build, "id long, keys array<binary>")


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int, batches: int) -> DataFrame:
    """(id, keys): hashes of the lines each document loses, from the runs all batches leave."""
    held = line_hashes(docs.where(F.col(id_col).isNotNull()), F.col(id_col), F.col(text_col), min_chars)
    lines = settle(
        held.select(F.pmod(F.xxhash64("id"), F.lit(batches)).alias("batch"), "id", F.explode("keys").alias("key")), "lines"
    )
    runs = LineRuns(docs.sparkSession)
    for i in range(batches):
        runs.add(lines.where(F.col("batch") == i))
    lost = lines.join(runs.frequent(min_docs), "key").where(F.col("id") != F.col("last_id"))
    return lost.groupBy("id").agg(F.collect_set("key").alias("keys"))


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS, batches: int = BATCHES,
) -> DataFrame:
    """All rows with their text less the repeated lines, plus __lines and __dropped (line counts).

    A line of at least ``min_chars`` code points found in ``min_docs`` documents stays only in the largest id that
    holds it. Ids are whole numbers. Rows sharing an id count as one document; rows without an id neither count nor lose
    lines. A null text is one empty line and stays null; texts and lines may be of any length. An empty table gives an
    empty result. Other columns pass through, but for ``__lines`` and ``__dropped`` of the input, which are replaced.
    """
    docs = docs.drop("__lines", "__dropped")
    lost = repeated_lines(docs, id_col, text_col, min_chars, min_docs, batches)
    names = docs.columns
    lost_id, lost_keys = unused("__id", names), unused("__keys", names)
    rows = docs.join(lost.select(F.col("id").alias(lost_id), F.col("keys").alias(lost_keys)),
                     F.col(id_col).cast("long") == F.col(lost_id), "left").drop(lost_id)

    def build():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, total, dropped = [], [], []
            for text, known, keys in zip(as_bytes(batch.column(text_col)), batch.column(text_col).is_valid().to_pylist(),
                                         batch.column(lost_keys).to_pylist(), strict=True):
                lines = text.split(b"\n")
                kept = lines
                if keys:
                    gone = set(keys)
                    kept = [x for x in lines if key_hash(line_key(x), min_chars) not in gone]
                texts.append((b"\n".join(kept) if keys else text) if known else None)
                total.append(len(lines))
                dropped.append(len(lines) - len(kept))
            new = {text_col: pa.array(texts, pa.binary()).cast(pa.string()), "__lines": pa.array(total, pa.int64()),
                   "__dropped": pa.array(dropped, pa.int64())}
            columns = [*names, "__lines", "__dropped"]
            return pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in columns], columns)

        return run

    return per_batch(rows, build, fields_and(docs.schema.fields, "__lines long, __dropped long"))
