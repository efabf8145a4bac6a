"""Secrets in texts: fixed patterns, and strings a tokenizer finds costly.

A tokenizer's vocabulary holds what occurs often, so prose and names give several characters per token and random
strings few. Runs of secret characters with a low ratio are reported as ``random``, except known digests (pure hex of a
digest's length), UUIDs, plain numbers and identifiers (words joined by dots, dashes or underscores, versions, file
names), and except runs that a fixed pattern already covers.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_bytes, per_batch
from .token_counts import SPLITTER

MIN_RUN, MAX_RATIO, MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 20, 2.0, 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

#: The patterns whose matches are always reported.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Hex lengths of common digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512).
DIGEST_LENGTHS = frozenset((32, 40, 56, 64, 96, 128))

_RUN = r"[A-Za-z0-9+/_=.~-]"
_DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Joiners at which a run is parted, those of paths before those within names.
_JOINERS = (re.compile(r"[^/.=~]+"), re.compile(r"[^/.=~+_-]+"))


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file of the tokenizer library: one base64 string and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def is_known(run: str, is_word: Callable[[str], bool]) -> bool:
    """Digests, UUIDs, numbers and identifiers: not secrets, however costly they are."""
    if _DIGEST.fullmatch(run) and len(run) in DIGEST_LENGTHS or _UUID.fullmatch(run):
        return True
    if not any(c.isalpha() for c in run):
        return True
    # Identifiers: nearly all letters stand in words; a few letters beside them are versions and initials.
    words = [w for w in _PART.findall(run) if w[0].isalpha()]
    return 5 * sum(len(w) for w in words if is_word(w)) >= 4 * sum(map(len, words))


def make_finder(ranks: dict[bytes, int], min_run: int, max_ratio: float) -> Callable[[str], list[tuple[str, int, int]]]:
    """Function from a text to its spans (kind, start, end), by start, then kind in the order of KINDS."""
    import tiktoken

    encoding = tiktoken.Encoding("secrets", pat_str=SPLITTER, mergeable_ranks=ranks, special_tokens={})
    assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
    # A run of letters is only worth a look where one of these stands; the test is much faster than the pattern.
    trigger = re.compile(r"[:=]")
    access, hexes = re.compile(r"AKIA[A-Z0-9]{%d,}" % (MIN_ACCESS - 4)), re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
    runs = re.compile(_RUN + "{%d,}" % min_run)

    def costly(run: str) -> bool:
        return len(run) < max_ratio * len(encoding.encode_ordinary(run))

    def is_word(letters: str) -> bool:
        return len(letters) >= 3 * len(encoding.encode_ordinary(letters))

    def judged(text: str, start: int, end: int, level: int = 0) -> list[tuple[int, int, int]]:
        """The stretch of a run if it is a secret, else those of its parts that are."""
        run = text[start:end].strip("=.-_~/+")
        if len(run) < min_run:
            return []
        start = text.index(run, start)
        end = start + len(run)
        if costly(run) and not is_known(run, is_word):
            return [(3, start, end)]
        if level == len(_JOINERS):
            return []
        parts = [m.span() for m in _JOINERS[level].finditer(run)]
        return [x for s, e in parts if e - s >= min_run for x in judged(text, start + s, start + e, level + 1)]

    def find(text: str) -> list[tuple[str, int, int]]:
        found = []
        if trigger.search(text):
            found += [(0, *m.span()) for m in assign.finditer(text) if len(m[2]) >= MIN_ASSIGN]
        if "AKIA" in text:
            found += [(1, *m.span()) for m in access.finditer(text)]
        long_runs = list(runs.finditer(text))
        found += [(2, *m.span()) for m in hexes.finditer(text)]
        base = list(found)
        for m in long_runs:
            at = m.start()
            for s, e in sorted((s, e) for _, s, e in base if s < m.end() and m.start() < e):
                found += judged(text, at, s) if s > at else []
                at = max(at, e)
            found += judged(text, at, m.end()) if at < m.end() else []
        return [(KINDS[k], s, e) for s, k, e in sorted((s, k, e) for k, s, e in found)]

    return find


def secret_spans(
    docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN,
    max_ratio: float = MAX_RATIO,
) -> DataFrame:
    """(id, spans array of kind, start, end) of every row; positions are code points, ends exclusive.

    A null or empty text has no spans; repeated rows and rows without an id are searched like any other.
    """
    ranks = read_ranks(ranks_path)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def build():
        find = make_finder(ranks, min_run, max_ratio)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [
                [{"kind": k, "start": s, "end": e} for k, s, e in find(x.decode())] for x in as_bytes(batch.column("text"))
            ]
            return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, span)], ["id", "spans"])

        return run

    return per_batch(rows, build, f"id {kind}, spans array<struct<kind: string, start: long, `end`: long>>")
