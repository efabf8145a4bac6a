"""Log-likelihood of documents under a gated recurrent language model learned from the corpus.

Word counts cover all training documents and are summed by Spark. The most frequent words, bounded in number and length,
go to every task: the first of them are the model's symbols, the others only need their count; counts of all other
words are joined. The recurrent model is trained on all training documents: each task trains a copy on the documents it
reads, the copies are averaged by Spark, weighted by tokens, and the next round starts from the average.

A word that is no symbol has the probability of the symbol UNKNOWN times its share of what such words count.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import recurrent
from .common import as_bytes, fields_and, per_batch, settle

#: Most words sent to every task, most bytes of one, and fewest symbols of the model (two of them UNKNOWN and END).
HEAD_WORDS, HEAD_BYTES, SYMBOLS = 1 << 17, 64, 2048
#: Beyond the fewest, one symbol for so many distinct words, up to a model that tasks can hold.
WORDS_A_SYMBOL, MOST_SYMBOLS = 16, 1 << 14
ROUNDS, SMOOTH, COUNTER_WORDS, CHUNKS = 2, 0.1, 250_000, 32
#: Tokens a copy of the model is trained on, about those of 8 MB: copies grow with the texts, not with their partitions.
COPY_TOKENS = 1_250_000
UNKNOWN, END = 0, 1
TAIL_ROWS = 256
END_WORD = "\n"  # no word holds white space


def words_of(data: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return data.lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over a column ``text``, with the number of texts as the count of END_WORD."""

    def run(batches):
        held: Counter[bytes] = Counter()

        def emptied():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )
            held.clear()

        for batch in batches:
            for text in as_bytes(batch.column("text")):
                held.update(words_of(text))
                held[END_WORD.encode()] += 1
                if len(held) > COUNTER_WORDS:
                    yield from emptied()
        yield from emptied()

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def head_words(counts: DataFrame, most: int = HEAD_WORDS) -> dict[bytes, int]:
    """The most frequent short words with their counts, at most ``most``, all down to some count; most frequent first."""
    short = counts.where((F.octet_length("word") <= HEAD_BYTES) & (F.col("word") != END_WORD))
    level = F.floor(F.log2("c") * 16).cast("int")
    levels = sorted(((r[0], r[1]) for r in short.groupBy(level).count().collect()), reverse=True)  # 16 a doubling
    least, total = None, 0
    for at, n in levels:
        if total + n > most:
            break
        least, total = at, total + n
    if least is None:
        return {}
    found = short.where(level >= least).collect()
    return {r["word"].encode(): r["c"] for r in sorted(found, key=lambda r: (-r["c"], r["word"]))}


def symbol_count(n_distinct: int) -> int:
    """Symbols of the model for so many distinct words."""
    return max(SYMBOLS, min(MOST_SYMBOLS, n_distinct // WORDS_A_SYMBOL))


class Numbers(dict):
    """Symbol of a word; UNKNOWN, and no entry, for all others."""

    def __missing__(self, word: bytes) -> int:
        return UNKNOWN

    def of(self, data: bytes) -> np.ndarray:
        words = words_of(data)
        out = np.empty(len(words) + 1, np.int32)
        out[:-1] = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        out[-1] = END
        return out


def _averaged(copies: DataFrame, fan_in: int) -> DataFrame:
    """Sums of weighted parameters by chunk, in two steps so that no task reads all copies.

    Copies bring their parameters as 32-bit numbers, sums have 64 bits.
    """
    schema = "chunk int, part int, weight double, numbers binary"

    def summed(weighted: bool):
        def run(table: pa.Table) -> pa.Table:
            weights = table.column("weight").to_pylist()
            parts = table.column("numbers").to_pylist()
            if weighted:
                total = sum(np.frombuffer(x, np.float64) for x in parts)
            else:
                total = sum(np.frombuffer(x, np.float32).astype(np.float64) * w for x, w in zip(parts, weights, strict=True))
            return pa.table({
                "chunk": table.column("chunk").slice(0, 1), "part": table.column("part").slice(0, 1),
                "weight": pa.array([sum(weights)]), "numbers": pa.array([total.tobytes()], pa.binary()),
            })

        return run

    first = copies.withColumn("part", F.col("part") % fan_in).groupBy("chunk", "part").applyInArrow(summed(False), schema)
    return first.groupBy("chunk").applyInArrow(summed(True), schema)


def copy_count(n_tokens: int) -> int:
    """Copies of the model that are trained on so many tokens."""
    return max(1, -(-n_tokens // COPY_TOKENS))


def train_round(texts: DataFrame, model: dict[str, np.ndarray], numbers: dict[bytes, int], copies: int) -> dict[str, np.ndarray]:
    """The average of at most ``copies`` copies that tasks train on their texts, each beginning with ``model``.

    Each copy is shuffled whole, so there must not be one for every small partition.
    """

    def run(batches):
        from pyspark import TaskContext

        known, trainer = Numbers(numbers), recurrent.Trainer(model)
        for batch in batches:
            trainer.learn([known.of(x) for x in as_bytes(batch.column("text"))])
        if trainer.tokens:
            parts = np.array_split(recurrent.flatten(trainer.model), CHUNKS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(CHUNKS), pa.int32()), pa.array([TaskContext.get().partitionId()] * CHUNKS, pa.int32()),
                 pa.array([float(trainer.tokens)] * CHUNKS), pa.array([x.tobytes() for x in parts], pa.binary())],
                ["chunk", "part", "weight", "numbers"],
            )

    trained = texts.coalesce(copies).mapInArrow(run, "chunk int, part int, weight double, numbers binary")
    rows = sorted(_averaged(trained, math.isqrt(copies)).collect(), key=lambda r: r["chunk"])  # CHUNKS rows, together one model
    if not rows:
        return model
    return recurrent.unflatten(np.concatenate([np.frombuffer(r["numbers"]) / r["weight"] for r in rows]), model)


def _tail_array(counters: list[Counter]) -> pa.Array:
    """Words and their number for each document, as a list of structs."""
    offsets = np.cumsum([0, *map(len, counters)]).astype(np.int32)
    words = pa.array([w for c in counters for w in c], pa.binary()).cast(pa.string())
    times = pa.array([k for c in counters for k in c.values()], pa.int64())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([words, times], ["word", "k"]))


def lm_scores(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", keep: tuple[Column, ...] = (),
    rounds: int = ROUNDS, symbols: int | None = None,
) -> DataFrame:
    """(row, keep columns, n_tokens, n_known, train_tokens, base_score, score) of every row, log10.

    ``learn`` (over docs) marks the rows to learn from. A text is its words and one end; a null text is empty.
    base_score sums log10((c + 0.1) / (N + 0.1 (V + 1))). Repeated rows are scored one by one; without any row to learn
    from, no word is known and the model is the one it starts with.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    training = docs.where(learn).select(text, F.pmod(F.xxhash64(F.col(id_col)), F.lit(rounds)).alias("round"))
    counts = settle(word_counts(training.select("text")), "word-counts")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max(F.when(F.col("word") == END_WORD, F.col("c"))), F.lit(0)))
    n_train, n_distinct, n_ends = totals.first()
    symbols = symbols or symbol_count(n_distinct)
    head = head_words(counts)
    names = list(head)[: symbols - 2]
    numbers = {w: i + 2 for i, w in enumerate(names)}
    in_model = sum(head[w] for w in names) + n_ends
    amounts = np.array([n_train - in_model, n_ends, *(head[w] for w in names), *[-1] * (symbols - 2 - len(names))], float)
    model = recurrent.new_model(amounts)
    for i in range(rounds):
        model = train_round(training.where(F.col("round") == i).select("text"), model, numbers, copy_count(n_train // rounds))

    others = n_train - in_model + SMOOTH * (n_distinct - len(names) - bool(n_ends) + 1)
    # No word holds white space, so the head travels as one text.
    head_text = b"\n".join(head)
    symbol = np.array([*(numbers.get(w, UNKNOWN) for w in head), UNKNOWN], np.int32)
    logs = np.array([*(math.log10(c + SMOOTH) for c in head.values()), 0.0])
    end_log = math.log10(n_ends + SMOOTH)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), *keep, text)
    kept = rows.schema.fields[:-1]

    def build():
        class Places(dict):
            def __missing__(self, word: bytes) -> int:
                return -1  # the last entry of symbol and logs

        find = Places((w, i) for i, w in enumerate(head_text.split())).__getitem__

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_tokens, n_known, n_other, head_log, other_log, texts = [], [], [], [], [], []
            tails, held = [], []
            for data in as_bytes(batch.column("text")):
                words = words_of(data)
                at = np.fromiter(map(find, words), np.int32, len(words))
                ids = symbol[at]
                values = logs[at]
                unknown = ids == UNKNOWN
                held.append(Counter(compress(words, (at < 0).tolist())))
                if len(held) == TAIL_ROWS:
                    tails.append(_tail_array(held))
                    held = []
                n_tokens.append(len(words) + 1)
                n_known.append(int(np.count_nonzero(at >= 0)) + (n_ends > 0))
                n_other.append(int(np.count_nonzero(unknown)))
                head_log.append(float(values.sum()) + end_log)
                other_log.append(float(values[unknown].sum()))
                texts.append(np.append(ids, END).astype(np.int32))
            tails.append(_tail_array(held))
            likely = recurrent.score(model, texts) / math.log(10) + np.array(other_log) - np.array(n_other) * math.log10(others)
            columns = [batch.column(f.name) for f in kept] + [
                pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(head_log, pa.float64()),
                pa.array(likely, pa.float64()), pa.concat_arrays(tails),
            ]
            return pa.RecordBatch.from_arrays(columns, [f.name for f in kept] + ["n_tokens", "n_known", "head_log", "likely", "tail"])

        return run

    scored = settle(
        per_batch(rows, build, fields_and(kept, "n_tokens long, n_known long, head_log double, likely double, tail array<struct<word: string, k: long>>")),
        "lm-scored",
    )
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.k")
    found = F.coalesce("c", F.lit(0))
    tail = tail.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(found + SMOOTH)).alias("tail_log"), F.sum(F.when(found > 0, F.col("k")).otherwise(0)).alias("tail_known")
    )
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    return scored.drop("tail").join(tail, "row", "left").select(
        *[f.name for f in kept], "n_tokens", (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("head_log") + tail_log - F.col("n_tokens") * math.log10(n_train + SMOOTH * (n_distinct + 1))).alias("base_score"),
        (F.col("likely") + tail_log).alias("score"),
    )
