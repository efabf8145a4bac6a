"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors, found by hashing: one for each of its words, one for each character
n-gram of its words, and one that all words equal to the word before them share. A softmax over the average gives the classes. Vectors and output are trained with stochastic gradient
descent in numpy on a bounded sample of labelled rows. Since average and output are linear, scoring keeps per word what
it adds to each class, so a known word costs one lookup.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, fields_and, per_batch, settle

BUCKETS, DIM, EPOCHS, RATE = 1 << 16, 12, 12, 1.0
MIN_GRAM, MAX_GRAM = 3, 4
#: Labelled rows the model is fitted on: those with the smallest hash of the id.
MAX_TRAIN_ROWS = 6000
#: Features of those rows together, 2 bytes each on the driver; about 1,700 a row make 10 million.
MAX_TRAIN_FEATURES = 25_000_000
REPEAT = BUCKETS  # the vector of a word that repeats the one before
MAX_WORDS, MAX_WORD_BYTES, PART = 600_000, 1 << 25, 1 << 16


def features_of(word: bytes) -> list[int]:
    """Buckets of a word and of its character n-grams (UTF-8 bytes, with marks at both ends)."""
    marked = b"<" + word + b">"
    out = [crc32(marked, 1) & (BUCKETS - 1)]  # BUCKETS is a power of two
    for n in range(MIN_GRAM, MAX_GRAM + 1):
        out += [crc32(marked[i : i + n]) & (BUCKETS - 1) for i in range(len(marked) - n + 1)]
    return out


@dataclass
class Model:
    vectors: np.ndarray  # BUCKETS + 1 x DIM
    output: np.ndarray  # DIM x classes
    bias: np.ndarray
    rows: int = 0  # learned from

    def buckets(self) -> np.ndarray:
        """What each bucket adds to each class."""
        return self.vectors @ self.output


def train(
    packed: np.ndarray, starts: np.ndarray, cuts: np.ndarray, labels: list[int], classes: int, epochs: int = EPOCHS, rate: float = RATE,
    seed: int = 7,
) -> Model:
    """Stochastic gradient descent over rows: row i has ``cuts[i + 1] - cuts[i]`` features and a class.

    Its features begin at ``packed[starts[i]]``, as ``pack_counts`` puts them; they are unpacked when it is their turn.

    The rate falls to zero over the epochs. Rows without features are passed over.
    """
    rng = np.random.default_rng(seed)
    model = Model(
        rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS + 1, DIM)).astype(np.float32), np.zeros((DIM, classes), np.float32),
        np.zeros(classes, np.float32),
    )
    rows = np.flatnonzero(np.diff(cuts))
    if not len(rows):
        return model
    model.rows = len(rows)
    share = np.bincount([labels[i] for i in rows], minlength=classes) + 1.0
    model.bias += np.log(share / share.sum()).astype(np.float32)
    step, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            i = rows[k]
            mine, counts = read_counts(packed[starts[i] : starts[i + 1]])
            weights = counts.astype(np.float32)
            weights /= weights.sum()
            hidden = weights @ model.vectors[mine]
            logits = hidden @ model.output + model.bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[labels[i]] -= 1
            now = rate * (1 - step / steps)
            back = model.output @ error
            model.output -= now * np.outer(hidden, error)
            model.bias -= 0.1 * now * error
            # Each bucket of a row is named once, so plain indexing adds up.
            model.vectors[mine] -= (now * len(mine) ** 0.5) * weights[:, None] * back[None, :]
            step += 1
    return model


def pack_counts(total: np.ndarray) -> bytes:
    """Features of a row in little space: the gaps between its buckets and the counts, as bytes, compressed.

    A gap or a count beyond 254 is written as 255 and its four bytes apart.
    """
    at = np.flatnonzero(total)
    numbers = np.concatenate([np.diff(at, prepend=-1), total[at]])
    large = numbers > 254
    head = np.array([len(at), np.count_nonzero(large)], np.uint32)
    return zlib.compress(head.tobytes() + np.where(large, 255, numbers).astype(np.uint8).tobytes() + numbers[large].astype(np.uint32).tobytes(), 1)


def read_counts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the bytes that ``pack_counts`` compresses."""
    size, n_large = np.frombuffer(data[:8].tobytes(), np.uint32).tolist()
    numbers = data[8 : 8 + 2 * size].astype(np.uint32)
    if n_large:
        numbers[numbers == 255] = np.frombuffer(data[8 + 2 * size :].tobytes(), np.uint32, n_large)
    return (np.cumsum(numbers[:size], dtype=np.int64) - 1).astype(np.int32), numbers[size:]


def unpack_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of ``pack_counts``."""
    return read_counts(np.frombuffer(zlib.decompress(data), np.uint8))


def row_features(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with their text replaced by ``packed``, the counts of its buckets, and ``n``, how many those are."""
    kept = [f for f in rows.schema.fields if f.name != text_col]

    def build():
        known: dict[bytes, np.ndarray] = {}

        def of(word: bytes) -> np.ndarray:
            found = known.get(word)
            if found is None:
                if len(known) >= MAX_WORDS // 20:
                    known.clear()
                found = known[word] = np.array(features_of(word), np.int32)
            return found

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            packed, sizes = [], []
            for text in as_bytes(batch.column(text_col)):
                total = np.zeros(BUCKETS + 1, np.int64)
                words = text.split()
                total[REPEAT] = sum(map(bytes.__eq__, words, words[1:]))
                for i in range(0, len(words), 4096):
                    total += np.bincount(np.concatenate([of(w) for w in words[i : i + 4096]]), minlength=BUCKETS + 1)
                packed.append(pack_counts(total))
                sizes.append(np.count_nonzero(total))
            return pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(packed, pa.binary()), pa.array(sizes, pa.int64())],
                [f.name for f in kept] + ["packed", "n"],
            )

        return run

    return per_batch(rows, build, fields_and(kept, "packed binary, n long"))


def training_rows(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str, max_rows: int
) -> DataFrame:
    """(__id, __label, packed, n) of the rows to learn from, in the order of the hash of the id, written once.

    Of documents that repeat an id the smallest text counts.
    """
    order = [F.xxhash64("__id"), F.col("__id"), F.col("__label")]
    chosen = labels.where(learn & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label")
    ).distinct().orderBy(*order).limit(max_rows)
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    # The limit bounds the side sent to every task, and with it the rows grouped.
    texts = rows.join(F.broadcast(chosen), "__id").groupBy("__id", "__label").agg(F.min("text").alias("text"))
    return settle(row_features(texts).orderBy(*order), "training-rows")


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS, max_features: int = MAX_TRAIN_FEATURES,
) -> Model:
    """Model of a 0/1 label from at most ``max_rows`` labelled rows for which ``learn`` (over labels) holds.

    Rows are taken by the hash of their id for as long as they have at most ``max_features`` features together, so what
    reaches the driver is bounded in bytes. Rows without id, label or text take no part; of documents that repeat an id
    the smallest text counts, with each label it has; texts of any length are read whole. Without any row left, as with
    empty tables, every score is one half.
    """
    found = training_rows(docs, labels, learn, id_col, text_col, label_col, max_rows)
    sizes = sorted((tuple(r) for r in found.select(F.xxhash64("__id"), "__id", "__label", "n").collect()))
    ends = np.cumsum([n for *_, n in sizes], dtype=np.int64)
    used = int(np.searchsorted(ends, max_features, side="right"))
    cuts = np.concatenate([[0], ends[:used]]).astype(np.int64)
    place = {(row_id, label): i for i, (_, row_id, label, _) in enumerate(sizes[:used])}
    rows = [b""] * used
    for row in found.select("__id", "__label", "packed").toLocalIterator():
        i = place.get((row["__id"], row["__label"]))
        if i is not None:
            rows[i] = zlib.decompress(row["packed"])
    starts = np.cumsum([0, *map(len, rows)], dtype=np.int64)
    packed = np.frombuffer(b"".join(rows), np.uint8)
    del rows
    return train(packed, starts, cuts, [label for _, _, label, _ in sizes[:used]], 2)


class _Words(dict):
    """Row of each word in a table of what it adds to each class, and its number of features."""

    def __init__(self, buckets: np.ndarray):
        super().__init__()
        # Plain lists: a word has few features, less than an array operation is worth.
        self.adds, self.size = [column.tolist() for column in buckets.T], 0
        self.table = np.zeros((1 << 12, buckets.shape[1] + 1))
        self.repeat = np.append(buckets[REPEAT], 1)

    def __missing__(self, word: bytes) -> int:
        found = features_of(word)
        row = len(self)
        if row >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[row] = [*(sum(map(adds.__getitem__, found)) for adds in self.adds), len(found)]
        self[word] = row
        self.size += len(word)
        return row

    def sums(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MAX_WORDS or self.size > MAX_WORD_BYTES:
            self.clear()
            self.size = 0
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        repeats = np.count_nonzero(rows[1:] == rows[:-1])
        return self.table[rows].sum(axis=0) + repeats * self.repeat


def with_scores(docs: DataFrame, model: Model, text_col: str, name: str) -> DataFrame:
    """All rows and columns with the probability of class 1 in a further column."""
    adds, bias = model.buckets().astype(np.float64), model.bias.astype(np.float64)
    at = docs.columns.index(text_col)
    names = [*docs.columns, name]

    def build():
        known = _Words(adds)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            totals = np.zeros((batch.num_rows, adds.shape[1] + 1))
            for i, text in enumerate(as_bytes(batch.column(at))):
                words = text.split()
                for k in range(0, len(words), PART):  # a part begins with the word that ended the one before
                    totals[i] += known.sums(words[max(0, k - 1) : k + PART])
                    if k:
                        before = known[words[k - 1]]
                        totals[i] -= known.table[before]
            logits = totals[:, :-1] / np.maximum(totals[:, -1:], 1) + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(odds[:, 1] / odds.sum(axis=1))], names)

        return run

    return per_batch(docs, build, fields_and(docs.schema.fields, f"`{name}` double"))


def quality_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id, score, predicted) of every row: the probability of class 1 and whether it reaches the threshold.

    A null or empty text gets the probability the bias gives; repeated rows and rows without an id are scored alike.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = with_scores(rows, model, "text", "score")
    return scored.select("id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
