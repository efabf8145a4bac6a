"""Language identification with rank-order profiles.

The most frequent character n-grams of a language, in order, are its profile. A document's own n-grams are ranked the
same way; its distance to a profile is the sum of how far each n-gram is out of place, and PROFILE for those missing.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, fields_and, per_batch, settle

MAX_GRAM, PROFILE = 3, 400
MAX_WORDS, MAX_GRAMS, MAX_FLAT, PART = 200_000, 200_000, 1 << 23, 50_000
UNKNOWN = "und"
#: Languages whose profiles a task holds at once.
BLOCK = 1000
TEXT, PRED, SCORE = "__text", "__lang_pred", "__score"

_WORD = re.compile(r"[^\W\d_]+")
_LETTERS = regex.compile(r"\p{L}+")
# ASCII but a-z, in no word, as spaces; bytes of other characters stay.
_SPACED = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def grams_of(word: str) -> list[str]:
    """Character n-grams of a word with a blank at each end; the lone blank is none.

    A run that ``_WORD`` takes may hold numerals that are no letters, such as one half: only its runs of letters count.
    """
    out = []
    for part in [word] if word.isalpha() else _LETTERS.findall(word):
        marked = f" {part} "
        out += part
        for n in range(2, MAX_GRAM + 1):
            out += [marked[i : i + n] for i in range(len(marked) - n + 1)]
    return out


def _with_room(values: np.ndarray, size: int) -> np.ndarray:
    """The values, with zeros behind them if there is no room for ``size``: twice as many at least."""
    return values if size <= len(values) else np.concatenate([values, np.zeros(max(len(values), size - len(values)), values.dtype)])


class _Numbers(dict):
    """Numbers in the order of first use, and a hash of each n-gram: ``order`` holds those made so far, room follows."""

    def __init__(self, items=()):
        super().__init__(items)
        self.fresh, self.order, self.hashed = list(self), np.zeros(1 << 12, np.uint64), 0

    def __missing__(self, gram: str) -> int:
        number = self[gram] = len(self)
        self.fresh.append(gram)
        return number

    def hashes(self) -> np.ndarray:
        """Hash of each n-gram by its number; only n-grams met since the last call cost anything."""
        if self.fresh:
            end = self.hashed + len(self.fresh)
            self.order = _with_room(self.order, end)
            self.order[self.hashed : end] = [xxhash.xxh3_64_intdigest(g) for g in self.fresh]
            self.hashed, self.fresh = end, []
        return self.order


class _Words(dict):
    """Number of each run of ``runs_of``, and the numbers of its words' n-grams one after the other in ``flat``."""

    def __init__(self, number: _Numbers):
        super().__init__()
        self.number = number
        self.flat, self.fresh = np.zeros(1 << 16, np.int64), []
        # Where the n-grams of each word begin, and after the last one where they end.
        self.first, self.ends, self.settled = np.zeros(1 << 12, np.int64), [], 0
        self.used = 0

    def __missing__(self, run: bytes) -> int:
        for word in _WORD.findall(run.decode()):
            self.fresh += map(self.number.__getitem__, grams_of(word))
        self.ends.append(self.used + len(self.fresh))
        number = self[run] = len(self)
        return number

    def settle(self) -> None:
        """Put the n-grams of words met since the last call into ``flat``."""
        if self.ends:
            end = self.used + len(self.fresh)
            self.flat = _with_room(self.flat, end)
            self.flat[self.used : end] = self.fresh
            self.used, self.fresh = end, []
            self.first = _with_room(self.first, len(self) + 1)
            self.first[self.settled + 1 : len(self) + 1] = self.ends
            self.settled, self.ends = len(self), []


class Grams:
    """Numbers for n-grams and, per run, the numbers of its n-grams; both are forgotten beyond a bound."""

    def __init__(self, fixed: list[str] = ()):
        self.fixed = list(fixed)
        self.forget()

    def forget(self) -> None:
        self.number = _Numbers((g, i) for i, g in enumerate(self.fixed))
        self.words = _Words(self.number)
        self.total, self.slot = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def full(self) -> bool:
        return len(self.words) > MAX_WORDS or self.words.used > MAX_FLAT or len(self.number) > len(self.fixed) + MAX_GRAMS

    def counts(self, words: Counter[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(n-gram numbers, occurrences) of counted runs, each n-gram once, in no order."""
        if self.full():
            self.forget()
        at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        self.words.settle()
        first = self.words.first.take(at)
        size = self.words.first.take(at + 1) - first
        before = np.cumsum(size) - size
        index = np.arange(int(size.sum()))
        grams = self.words.flat.take(np.repeat(first - before, size) + index)
        times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), size)
        if len(self.total) < len(self.number):
            self.total, self.slot = (np.zeros(2 * len(self.number), np.int64) for _ in range(2))
        # ``total`` is zero but for this text; of equal n-grams the one whose index stays in its slot stands for all.
        np.add.at(self.total, grams, times)
        self.slot[grams] = index
        once = grams[self.slot.take(grams) == index]
        found = self.total.take(once)
        self.total[once] = 0
        return once, found


def runs_of(text: str) -> list[bytes]:
    """Runs of a-z and characters beyond ASCII in the lower-cased text: each word lies within one."""
    return text.lower().encode().translate(_SPACED).split()


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n) as each task counts them; the same pair may come from many tasks.

    A task counts the runs of each language and takes them apart when it holds MAX_WORDS different ones, and at its end.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def run(batches):
        grams, words = Grams(), defaultdict(Counter)

        def emptied():
            for lang, counted in words.items():
                items = list(counted.items())
                for i in range(0, len(items), PART):
                    at, n = grams.counts(Counter(dict(items[i : i + PART])))
                    names = list(grams.number)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(at), pa.string()), pa.array([names[k] for k in at], pa.string()), pa.array(n)],
                        ["lang", "gram", "n"],
                    )
            words.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), as_bytes(batch.column("text")), strict=True):
                words[lang].update(runs_of(text.decode()))
            if sum(map(len, words.values())) > MAX_WORDS:
                yield from emptied()
        yield from emptied()

    return rows.mapInArrow(run, "lang string, gram string, n long")


def profiles(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> dict[str, list[str]]:
    """The ``size`` most frequent n-grams of each language over all rows for which ``learn`` holds, ties by text.

    Rows without text or language teach nothing, repeated rows count each, texts are read whole; an empty table gives no
    profile. What is collected is ``size`` n-grams for each different language.
    """
    known = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = gram_counts(known, text_col, lang_col).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = counts.withColumn("place", place).where(F.col("place") <= size).collect()
    out: dict[str, dict[int, str]] = {}
    for row in rows:
        out.setdefault(row["lang"], {})[row["place"]] = row["gram"]
    return {lang: [grams[i] for i in sorted(grams)] for lang, grams in sorted(out.items())}


def make_ranker(known: dict[str, list[str]], size: int):
    """Function from a text to (language, score); ties of frequency by a hash, ties of distance by language."""
    langs = list(known)
    fixed = list(dict.fromkeys(g for grams in known.values() for g in grams))
    place = {g: i for i, g in enumerate(fixed)}
    ranks = np.full((len(langs), len(fixed)), -1, np.int64)
    for i, lang in enumerate(langs):
        ranks[i, [place[g] for g in known[lang]]] = np.arange(len(known[lang]))
    grams = Grams(fixed)

    def find(text: str) -> tuple[str, float]:
        words = Counter(runs_of(text))
        if not words or not langs:
            return UNKNOWN, 0.0
        at, counts = grams.counts(words)
        if not len(at):
            return UNKNOWN, 0.0
        order = grams.number.hashes()
        if len(at) > size:
            # Only n-grams at least as frequent as the one in the last place can rank.
            enough = counts >= np.partition(counts, len(at) - size)[len(at) - size]
            at, counts = at[enough], counts[enough]
        at = at[np.lexsort((order[at], -counts))][:size]
        spots = np.flatnonzero(at < len(fixed))
        theirs = ranks[:, at[spots]]
        apart = np.where(theirs >= 0, np.abs(theirs - spots), size).sum(axis=1) + size * (len(at) - len(spots))
        best = int(apart.argmin())
        return langs[best], float(1 - apart[best] / (size * len(at)))

    return find


def _best(rows: DataFrame, known: dict[str, list[str]], size: int) -> DataFrame:
    """Rows with lang_pred and score: the nearest of these profiles, or what the rows bring if that is as near."""
    names = [n for n in rows.columns if n not in (PRED, SCORE)]
    kept = [f for f in rows.schema.fields if f.name in names]
    again = PRED in rows.columns

    def build():
        find = make_ranker(known, size)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [find(x.decode()) for x in as_bytes(batch.column(TEXT))]
            if again:
                earlier = zip(batch.column(PRED).to_pylist(), batch.column(SCORE).to_pylist(), strict=True)
                found = [new if old[0] == UNKNOWN or new[1] > old[1] else old for old, new in zip(earlier, found, strict=True)]
            return pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                [*names, PRED, SCORE],
            )

        return run

    return per_batch(rows, build, fields_and(kept, f"`{PRED}` string, `{SCORE}` double"))


def languages(docs: DataFrame, known: dict[str, list[str]], text_col: str = "text", size: int = PROFILE, keep: tuple[Column, ...] = ()) -> DataFrame:
    """``keep`` of every row with lang_pred and score (1: every n-gram in its place, 0: none).

    Texts that are null or have no letter get ``und`` and 0, as all do when there is no profile; numerals that are no
    decimal digits are no letters. Repeated rows are each predicted alike, texts are read whole whatever their length, an
    empty table gives no rows, and of equally near languages the first by name is taken. A task holds the profiles of
    BLOCK languages; of more, each block has its own pass and the nearest so far is carried on.
    """
    rows = docs.select(*keep, F.col(text_col).alias(TEXT))
    langs = list(known)
    for i in range(0, max(len(langs), 1), BLOCK):
        rows = _best(settle(rows, "languages") if i else rows, {x: known[x] for x in langs[i : i + BLOCK]}, size)
    kept = [c for c in rows.columns if c not in (TEXT, PRED, SCORE)]
    return rows.select(*kept, F.col(PRED).alias("lang_pred"), F.col(SCORE).alias("score"))
